"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Texts first: rows are sorted by these before they are shuffled, and like texts side by side
# are compressed best.
NEAR_DUPLICATE_KEYS = (
    "txn_description",
    "payee",
    "bank_account_id",
    "posted_at_timestamp",
    "amount",
)


# Marks of repeated keys: bits a key while they last, and the most of them in all (32 MB).
BITS_A_KEY = 16
MOST_BITS = 1 << 28

# Bits of a hash: the low WORD_BITS tell one of at most MOST_BITS / 64 words, and three times six
# more the bits in it.  With 48 in all, billions of keys hardly meet by chance; more would only
# be more to shuffle.
WORD_BITS = 22
HASH_BITS = 48

# Stores a table under a name and reads it back.
Staged = Callable[[DataFrame, str], DataFrame]


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def repeats_apart(
    stored: DataFrame, keys: list[str], staged: Staged, bits: int | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose keys occur once, and all others or None; some of the former may be among the latter.

    Only hashes of the keys are shuffled to find those that repeat.  They are marked in a
    table of bits, bounded whatever their number, that every task gets, so no row is
    shuffled to be told apart.  Rows of equal keys have equal hashes and are never parted;
    the more marks there are, the more rows without a double are taken for one with.
    ``stored`` is read three times and should be a stored table.
    """
    repeated = repeated_hashes([stored], keys, staged)
    n = repeated.count()
    if n == 0:
        return stored, None
    return _parted(stored, keys, repeated, n, staged, bits)


def repeated_hashes(tables: list[DataFrame], keys: list[str], staged: Staged) -> DataFrame:
    """Hashes that occur more than once among the keys of all tables together."""
    hashed = [table.select(_hash(keys).alias("_hash")) for table in tables]
    counted = reduce(DataFrame.union, hashed).groupBy("_hash").agg(F.count(F.lit(1)).alias("n"))
    return staged(counted.where("n > 1").select("_hash"), "repeated-keys")


def marked_apart(stored: DataFrame, key: str, hashes: DataFrame, staged: Staged) -> tuple[DataFrame, DataFrame]:
    """The rows of ``stored`` whose hash is not among ``hashes``, and all others, without a shuffle."""
    return _parted(stored, [key], hashes, hashes.count(), staged)


def matches_apart(stored: DataFrame, key: str, wanted: DataFrame, staged: Staged) -> tuple[DataFrame, DataFrame]:
    """The rows of ``stored`` whose key is not in ``wanted``, and all others; some of the former may be among the latter.

    No row is shuffled to be told apart.
    """
    hashes = staged(wanted.select(_hash([key]).alias("_hash")), "wanted-keys")
    return marked_apart(stored, key, hashes, staged)


def may_match(stored: DataFrame, key: str, wanted: DataFrame, staged: Staged) -> DataFrame:
    """The rows of ``stored`` whose key is in ``wanted``, and a few others, without a shuffle."""
    return matches_apart(stored, key, wanted, staged)[1]


def _parted(
    stored: DataFrame, keys: list[str], hashes: DataFrame, n: int, staged: Staged, bits: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``stored`` not marked, and those marked, by the ``n`` hashes of ``hashes``.

    A hash marks three bits of one word, so few rows are marked by chance: with 16 bits a
    hash about one in a hundred, with 7 about six.
    """
    size = bits or min(MOST_BITS, 1 << max(12, (BITS_A_KEY * n).bit_length()))

    def marks_of(hashed: str) -> str:
        places = [f"shiftright({hashed}, {WORD_BITS + 6 * i}) & 63L" for i in range(3)]
        return " | ".join(f"shiftleft(1L, cast({place} AS int))" for place in places)

    words = hashes.groupBy(F.expr(f"_hash % {size // 64}L AS word")).agg(
        F.expr(f"bit_or({marks_of('_hash')})").alias("bits")
    )
    chunks = words.groupBy(F.expr("word div 64 AS _chunk")).agg(
        F.expr("map_from_entries(collect_list(struct(cast(word % 64 AS int) AS at, bits)))").alias("found")
    )
    marks = staged(
        chunks.selectExpr("_chunk", "transform(sequence(0, 63), i -> coalesce(found[i], 0L)) AS _words"), "marks"
    )
    marked = (
        stored.withColumn("_hash", _hash(keys))
        .withColumn("_word", F.expr(f"_hash % {size // 64}L"))
        .withColumn("_chunk", F.expr("_word div 64"))
        .withColumn("_marks", F.expr(marks_of("_hash")))
        .join(F.broadcast(marks), "_chunk", "left")
    )
    again = F.expr("coalesce((_words[cast(_word % 64 AS int)] & _marks) = _marks, false)")
    marked = marked.select(*stored.columns, again.alias("_again"))
    return marked.where("NOT _again").drop("_again"), marked.where("_again").drop("_again")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under ``order``; NULL keys form one group.

    The ``= 1`` filter lets Spark place a group limit before the exchange, so a
    map task ships at most one row per key and a hot key costs one row per task.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).where(F.col("_rank") == 1).drop("_rank")


def latest_by(
    df: DataFrame, keys: list[str], newest: str, ties: list[str]
) -> DataFrame:
    """The row with the largest ``newest`` per key, ties broken downwards."""
    order = [F.col(name).desc_nulls_last() for name in [newest, *ties]]
    return first_per_key(df, keys, order)


def collapse_near_duplicates(fact: DataFrame, staged: Staged | None = None) -> DataFrame:
    """Treat equal account, description, payee, time and amount as one row.

    With ``staged`` only rows that may have a double are shuffled, see ``repeats_apart``.
    """
    if staged is not None:
        once, several = repeats_apart(fact, list(NEAR_DUPLICATE_KEYS), staged)
        return once if several is None else once.unionByName(collapse_near_duplicates(several))
    ties = ("record_loaded_at_timestamp", "filename", "txn_id")
    return first_per_key(
        fact,
        list(NEAR_DUPLICATE_KEYS),
        [F.col(name).asc_nulls_last() for name in ties],
    )
