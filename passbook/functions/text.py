"""Text predicates, merchant keys and catalog patterns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that make a transfer an expense rather than a move of
# one's own money.  The two reports use different words for the card.
EXPENSE_TRANSFER_WORDS = ("credit card", "mortgage")
BALANCE_TRANSFER_WORDS = ("cashreward", "mortgage")

_ANCHOR_OR_SKIP = re.compile(r"\\.|\[\^?\]?(?:\\.|[^\]])*\]|\$", re.DOTALL)


def mentions(col: Column, word: str) -> Column:
    """Case-insensitive containment; NULL text stays NULL and drops out."""
    return col.ilike(f"%{word}%")


def counts_as_spending(description: Column, words: tuple[str, ...]) -> Column:
    """Everything except transfers, plus transfers that name one of ``words``."""
    named = mentions(description, words[0])
    for word in words[1:]:
        named = named | mentions(description, word)
    return ~mentions(description, "transfer") | named


def merchant_key(payee: Column, description: Column) -> Column:
    parts = [F.coalesce(F.lower(part), F.lit("NULL")) for part in (payee, description)]
    return F.md5(F.concat(parts[0], F.lit("||"), parts[1]))


def java_pattern(pattern: str) -> str:
    """Make Java's matcher agree with linear-time engines on line ends.

    ``(?d)`` leaves newline as the only line terminator for the dot, and ``\\z``
    replaces ``$``, which in Java also matches before a final newline.
    """
    strict_end = _ANCHOR_OR_SKIP.sub(
        lambda m: r"\z" if m.group() == "$" else m.group(), pattern
    )
    return "(?d)" + strict_end


def java_pattern_column(pattern: Column) -> Column:
    """``java_pattern`` for patterns that stay in a column."""
    strict_end = F.regexp_replace(
        pattern,
        r"(?s)\G((?:[^\\\[$]|\\.|\[\^?\]?(?:\\.|[^\]])*\])*+)\$",
        r"$1\\z",
    )
    return F.concat(F.lit("(?d)"), strict_end)
