"""Join many rows to a one-row-per-key table when some keys are hot."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows are cut into pieces of at most 1/PIECES of all rows; a key that holds
# more is hot.  So there are fewer than PIECES hot keys, and fewer than twice
# PIECES copies of their lookup rows, however large the data is.
PIECES = 100_000
MIN_PIECE = 100_000

# A stored table of at most so many rows is sent whole to every task.
SMALL = 200_000


def is_small(stored: DataFrame) -> bool:
    """Whether a table has at most ``SMALL`` rows; it is counted, so it should be a stored one."""
    return stored.count() <= SMALL


def small(stored: DataFrame) -> DataFrame:
    """``stored``, marked for a broadcast if it is small.

    A small table is joined without a shuffle of the rows on the other side, whatever size
    the session broadcasts by itself.
    """
    return F.broadcast(stored) if is_small(stored) else stored


def salted_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weight: str,
    spread: str,
    how: str = "inner",
    min_piece: int | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` on ``keys``, spreading hot keys over salts.

    ``lookup`` is unique by ``keys`` and its ``weight`` column counts the rows of
    each key.  A hot key gets one salt per piece it holds; its rows, marked by a
    broadcast of the hot keys, are spread by a hash of the ``spread`` column, and
    its lookup row is copied once per salt.  All other keys use salt 0.  Keys
    lighter than ``min_piece`` rows (``MIN_PIECE`` by default) are never hot.
    """
    least = MIN_PIECE if min_piece is None else min_piece
    total = lookup.agg(F.sum(weight)).scalar()
    piece = F.greatest(total / F.lit(PIECES), F.lit(least))
    salts = F.ceil(F.col(weight) / piece).cast("int")
    sized = lookup.withColumn("_salts", salts)

    # The first condition follows from the second; it is one a scan can use.
    is_hot = (F.col(weight) > least) & (F.col("_salts") > 1)
    hot_keys = sized.where(is_hot).select(*keys, "_salts")
    no_key = reduce(or_, [F.col(key).isNull() for key in keys])
    salts_of_row = F.when(no_key, F.lit(PIECES)).otherwise(F.col("_salts"))
    salt = F.pmod(F.xxhash64(spread), salts_of_row).cast("int")
    spread_rows = (
        rows.join(F.broadcast(hot_keys), keys, "left")
        .withColumn("_salt", F.coalesce(salt, F.lit(0)))
        .drop("_salts")
    )

    every_salt = F.sequence(F.lit(0), F.greatest("_salts", F.lit(1)) - 1)
    copies = sized.withColumn("_salt", F.explode(every_salt)).drop("_salts")
    return spread_rows.join(copies, [*keys, "_salt"], how).drop("_salt", weight)
