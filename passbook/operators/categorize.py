"""Assign each description the category of its best matching pattern.

The catalog is an inverted index.  A pattern is a set of alternatives, and what an
alternative matches must hold its literal text, so also each piece (gram) of it.  A run of
literal text is read in grams of the largest of ``SIZES`` that fits: there are so few
different short grams that each would be held by a fixed share of all descriptions.  Every
alternative is filed under the one of its grams that the fewest distinct descriptions hold;
descriptions meet patterns by equality of grams, told by their hashes, and the regular
expression runs on these hits alone.

A pattern with an alternative without three literal characters in a row, or of a form
that ``literal_grams`` does not read, could match any text.  It is filed under the empty
gram, which every description holds too; both sides spread over ``SPREAD`` salts there.

Descriptions, patterns and what comes of them are joined by shuffle and sort.  Spark would
judge their size by the compressed files they come from, where names that repeat are next
to nothing, and gather millions of them in the driver for a broadcast.  For the same reason
they are dealt over all cores before they unfold to grams and hits: by their bytes alone
one task would get them all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.functions.text import java_pattern_column
from passbook.operators.latest import first_per_key

UNKNOWN = "**UNKNOWN**"
GRAM = 3
SIZES = (12, 6, GRAM)
SPREAD = 64
TASKS_A_CORE = 3

CATALOG_ORDER = (
    "match_priority",
    "merchant_category",
    "merchant_subcategory",
    "regex_match_pat",
)

# Stands for whatever is no literal character of a pattern.
GAP = "\u0001"

# Escapes of letters and digits other than classes and word edges, inline flags and
# look-arounds, counted repeats, and quoted text: forms that are not read.
UNREAD = r"\\[^\WdDwWsSbB]|\(\?[^:]|[{}]|\x01"
ESCAPE_OR_CLASS = r"(?s)\\.|\[\^?\]?(?:\\.|[^\]])*\]"


def _pieces(text: Column, size: int) -> Column:
    """All runs of ``size`` characters of a text."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1)))
    pieces = F.transform(starts, lambda at: F.substring(text, at, F.lit(size)))
    return F.coalesce(pieces, F.array().cast("array<string>"))


def _grams(text: Column) -> Column:
    """All distinct runs of ``GRAM`` characters of a text."""
    return F.array_distinct(_pieces(text, GRAM))


def _hashed(grams: Column) -> Column:
    return F.array_distinct(F.transform(grams, lambda gram: F.xxhash64(gram)))


def _filed_grams(part: Column) -> Column:
    """Hashes of the grams of an alternative, of the largest size that fits into each literal run."""
    runs = F.split(part, GAP, -1)

    def pieces(run: Column) -> Column:
        fits = F.when(F.length(run) >= SIZES[0], _pieces(run, SIZES[0]))
        for size in SIZES[1:]:
            fits = fits.when(F.length(run) >= size, _pieces(run, size))
        return fits.otherwise(F.array().cast("array<string>"))

    return _hashed(F.flatten(F.transform(runs, pieces)))


def _alternatives(pattern: Column) -> Column:
    """The literal text of each alternative of a pattern, with a gap for all else; NULL if not read.

    Reads patterns of alternatives without a group, or with one group around them that
    is matched once or more.
    """
    marked = F.replace(F.regexp_replace(pattern, ESCAPE_OR_CLASS, GAP), F.lit("(?:"), F.lit("("))

    def split(marked: Column) -> Column:
        # What may be missing is a gap; what comes once or more is there once, then a gap.
        plain = F.regexp_replace(marked, r"(?s)[^()|][*?][+?]?", GAP)
        plain = F.regexp_replace(plain, r"\+[+?]?", GAP)
        plain = F.regexp_replace(plain, r"[.^$]", GAP)
        unread = pattern.rlike(UNREAD) | marked.rlike(r"\)[*?]")
        return F.when(~unread, _once(plain, parts))

    def parts(plain: Column) -> Column:
        around = r"(?s)^([^()|]*)\(([^()]*)\)([^()|]*)$"
        before, inside, after = (F.regexp_extract(plain, around, i) for i in (1, 2, 3))
        # A group that may repeat joins its end to its start or to what follows it.
        whole = F.transform(F.split(inside, r"\|", -1), lambda part: F.concat(before, part, after))
        return (
            F.when(plain.rlike(r"[\[\]*?]"), None)
            .when(plain.rlike(around), whole)
            .when(~plain.rlike("[()]"), F.split(plain, r"\|", -1))
        )

    return _once(marked, split)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _of_readable(alternatives: Column, grams: Column) -> Column:
    """``grams`` of the alternatives if each holds some literal gram, else an empty list."""
    literal = rf"[^{GAP}]{{{GRAM}}}"
    readable = F.coalesce(F.forall(alternatives, lambda part: part.rlike(f"(?s){literal}")), F.lit(False))
    return F.when(readable, grams).otherwise(F.array())


def literal_grams(pattern: Column) -> Column:
    """For each alternative of a pattern the grams that any match must hold.

    An empty list tells that the pattern may match any text.
    """
    parts = _alternatives(pattern)
    grams = F.transform(
        parts, lambda part: F.filter(_grams(part), lambda gram: ~F.contains(gram, F.lit(GAP)))
    )
    return _of_readable(parts, grams)


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` over ``TASKS_A_CORE`` tasks for each core, however few bytes they are.

    By a hash of the key: Spark takes dealing by the key for what a ``distinct`` has done already.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(TASKS_A_CORE * cores, F.xxhash64(key))


def _held(texts: DataFrame) -> DataFrame:
    """One row per text and hashed gram in it."""
    grams = F.concat(*[_pieces(F.col("text"), size) for size in SIZES])
    return texts.select("text", F.explode(_hashed(grams)).alias("gram"))


def _salted(texts: DataFrame) -> DataFrame:
    """The empty gram, which every text holds, with a salt."""
    salt = F.pmod(F.xxhash64("text"), F.lit(SPREAD)).cast("int")
    return texts.select("text", F.xxhash64(F.lit("")).alias("gram"), salt.alias("salt"))


def pattern_index(patterns: DataFrame, texts: DataFrame) -> DataFrame:
    """``gram``, ``salt`` and ``pattern``: where to look for texts that a pattern may match."""
    literals = patterns.select("pattern", _alternatives(F.col("pattern")).alias("literals"))
    found = F.transform(F.col("literals"), _filed_grams)
    read = literals.select("pattern", _of_readable(F.col("literals"), found).alias("parts"))
    # Patterns without any gram have no part; so no filter reads them before they are dealt.
    filed = read.select("pattern", F.posexplode_outer("parts").alias("part", "grams")).select(
        "pattern", "part", F.explode_outer("grams").alias("gram")
    )
    filed = filed.withColumn("gram", F.coalesce("gram", F.xxhash64("pattern")))
    spread = _held(texts).groupBy("gram").agg(F.count(F.lit(1)).alias("n_texts"))
    # An alternative with a gram that no text holds matches nothing; else the rarest counts.
    rarest = (
        filed.join(spread.hint("merge"), "gram", "left")
        .withColumn("n_texts", F.coalesce("n_texts", F.lit(0)))
        .groupBy("pattern", "part")
        .agg(F.min(F.struct("n_texts", "gram")).alias("least"))
        .where("part IS NULL OR least.n_texts > 0")
    )
    everywhere = F.col("part").isNull()
    salts = F.when(everywhere, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    gram = F.when(everywhere, F.xxhash64(F.lit(""))).otherwise(F.col("least.gram"))
    return rarest.select(gram.alias("gram"), F.explode(salts).alias("salt"), "pattern").distinct()


def matches(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct pairs of a ``text`` and a ``pattern`` that matches somewhere in it."""
    texts = _dealt(texts.where("text IS NOT NULL").distinct(), "text")
    patterns = _dealt(patterns.where("pattern IS NOT NULL").distinct(), "pattern")
    held = _held(texts).withColumn("salt", F.lit(0)).unionByName(_salted(texts))
    # One expression after the other meets its texts, so each is compiled once for all of them.
    index = pattern_index(patterns, texts).withColumn("_java", java_pattern_column(F.col("pattern")))
    hits = index.hint("merge").join(held, ["gram", "salt"])
    found = hits.where(F.rlike("text", F.col("_java")))
    return found.select("text", "pattern").distinct()


def categorize(df: DataFrame, catalog: DataFrame, text: str) -> DataFrame:
    """Add merchant_category, merchant_subcategory and match_priority.

    The lowest priority wins, then category, subcategory and pattern; rows without a
    match become ``**UNKNOWN**``.  One path for a catalog of any length.
    """
    patterns = catalog.select(F.col("regex_match_pat").alias("pattern"))
    found = matches(df.select(F.col(text).alias("text")), patterns)
    ranked = found.hint("merge").join(catalog, F.col("pattern") == F.col("regex_match_pat"))
    best = first_per_key(ranked, ["text"], [F.col(name).asc_nulls_last() for name in CATALOG_ORDER])
    hit = best.select(
        F.col("text").alias("_text"),
        F.col("merchant_category").alias("_category"),
        F.col("merchant_subcategory").alias("_subcategory"),
        "match_priority",
    )
    return df.join(hit.hint("merge"), F.col(text) == F.col("_text"), "left").select(
        *df.columns,
        F.coalesce("_category", F.lit(UNKNOWN)).alias("merchant_category"),
        F.coalesce("_subcategory", F.lit(UNKNOWN)).alias("merchant_subcategory"),
        "match_priority",
    )
