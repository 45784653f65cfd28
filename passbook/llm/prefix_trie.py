"""The trie of conversation prefixes, by ROLLUP over positional turn ids.

A node is a distinct sequence of first turns, its members the conversations that start
with it; it is named by its depth and its smallest member.  A turn's id is 16 bytes of a
SHA-256 over role and text, so texts are read once and never shuffled twice.

1. Places.  Turns are range-sorted by conversation and turn, and a turn's place is its
   place in its file plus the conversation's turns in earlier files, so a conversation of
   any length spreads over tasks.
2. Blocks.  ``WIDTH`` consecutive turns of a conversation are one row with the positional
   columns ``t1`` .. ``t8``.  A block carries the key of the prior block's node: two XORs
   over hashes of (place, turn id) of all turns before it, 128 bits, computed by a running
   XOR within ``RUN`` blocks and over the totals of earlier runs.
3. ``ROLLUP`` over ``t1`` .. ``t8`` within (block, prior node) aggregates all prefixes
   together; ``grouping_id`` tells a row's depth.  Long conversations thus continue in
   further blocks of the same eight columns, all in one job, and hot prefixes meet as
   partial sums.
4. Subtrees need no walk.  The nodes whose smallest member is conversation m are a
   contiguous range of depths, so a sum over a subtree is a sum over its members of what
   each one owns there; a second ROLLUP over the same blocks adds it up.
5. Conversations that end at a node are joined into text in chunks of at most ``CHUNK``
   ids and hashed as a stream, one chunk in memory at a time.

Cases: NULL role or text counts as empty; rows of a NULL conv_id belong to no conversation;
turns of one number, NULL included, go by the digest of role and text, so repeated rows are
turns of their own; a conversation without any turn left is a member of the root alone; an
empty table has no root; texts of any length become one id; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passbook.llm.tables import Temporary, stored
from passbook.operators.lookup import salted_lookup

WIDTH = 8
RUN = 4096
CHUNK_BITS = 12
GROUP = 20
HEADS = 4
FILE_BITS = 33  # monotonically_increasing_id keeps the place in the partition below
HOT_NODE = 1024
TURNS = [f"t{i}" for i in range(1, WIDTH + 1)]
WORDS = [f"w{i}" for i in range(WIDTH)]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that tell one (role, text) from all others."""
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(both.cast("binary"), 256)), 1, 16)


def _head(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its group."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def _hashes(place: Column, turn: Column) -> list[Column]:
    return [F.xxhash64(place, turn), F.xxhash64(turn, F.lit("node"), place)]


def _placed(conversations: DataFrame, temp: Temporary) -> tuple[DataFrame, DataFrame]:
    """Every original turn with its place from 1 on, and the length of each conversation."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        turn_id(role, text).alias("t"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),  # parts repeated rows
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("t"), F.col("row")]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = temp(
        turns.select("conv_id", "t", "words", F.monotonically_increasing_id().alias("at")).withColumn(
            "file", F.shiftright("at", FILE_BITS)
        ),
        "turns",
    )
    parts = turns.groupBy("file", "conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("conv_id").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    parts = temp(parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "parts")
    lengths = parts.groupBy("conv_id").agg(F.sum("n").alias("len"))

    # What a conversation takes over from the first of its group, and its length then.
    first = lengths.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len"))
    own = lengths.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    own = own.withColumn("h", _head(F.col("conv_id"))).join(first, "base", "left")
    taken = F.least(F.col("h").cast("long"), F.coalesce("base_len", F.lit(0)))
    own = own.withColumn("taken", taken).withColumn(
        "total", F.col("taken") + F.greatest(F.col("len") - F.col("h"), F.lit(0))
    )
    own = temp(own.select("conv_id", "base", "h", "taken", "total"), "lengths")

    # (file, conv_id) holds one file's turns, so this join has no hot key.
    seats = parts.join(own.select("conv_id", "h", "taken", "total"), "conv_id")
    placed = turns.join(seats.drop("n"), ["file", "conv_id"]).withColumn(
        "place", F.col("at") - F.col("first") + F.col("before") + 1
    )
    return temp(placed.select("conv_id", "t", "words", "place", "h", "taken", "total"), "placed"), own


def _blocks(conversations: DataFrame, temp: Temporary) -> DataFrame:
    """One row per block of a rebuilt conversation, with the key of the node before it."""
    placed, own = _placed(conversations, temp)
    tails = placed.where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "t", "words", "total"
    )
    heads = placed.where((F.col("conv_id") % GROUP == 0) & (F.col("place") < HEADS))
    heads = heads.select(F.col("conv_id").alias("base"), "place", "t", "words")
    heads = own.join(heads, "base").where("place <= taken").select("conv_id", "place", "t", "words", "total")
    turns = tails.unionByName(heads)

    at = (F.col("place") - 1) % WIDTH
    x, y = _hashes(F.col("place"), F.col("t"))
    rows = turns.groupBy("conv_id", F.floor((F.col("place") - 1) / WIDTH).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(at.alias("at"), "t", "words"))).alias("turns"),
        F.bit_xor(x).alias("x"),
        F.bit_xor(y).alias("y"),
        F.sum("words").alias("words"),
        F.first("total").alias("total"),
    )
    turnless = own.where("total = 0").select(
        "conv_id",
        F.lit(0).cast("long").alias("block"),
        F.array().cast(rows.schema["turns"].dataType).alias("turns"),
        F.lit(0).cast("long").alias("x"),
        F.lit(0).cast("long").alias("y"),
        F.lit(0).cast("long").alias("words"),
        "total",
    )
    rows = temp(rows.unionByName(turnless).withColumn("run", F.floor(F.col("block") / RUN)), "runs")

    within = Window.partitionBy("conv_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("conv_id", "run").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("words").alias("words")
    )
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations of more than RUN blocks have rows here.
    earlier = runs.select(
        "conv_id",
        "run",
        F.bit_xor("x").over(before).alias("rx"),
        F.bit_xor("y").over(before).alias("ry"),
        F.sum("words").over(before).alias("rw"),
    ).where("run > 0")
    none = F.lit(0).cast("long")
    keyed = rows.join(earlier, ["conv_id", "run"], "left")
    keyed = keyed.select(
        "conv_id",
        "block",
        "run",
        "total",
        F.coalesce(F.bit_xor("x").over(within), none).bitwiseXOR(F.coalesce("rx", none)).alias("kx"),
        F.coalesce(F.bit_xor("y").over(within), none).bitwiseXOR(F.coalesce("ry", none)).alias("ky"),
        (F.coalesce(F.sum("words").over(within), none) + F.coalesce("rw", none)).alias("w0"),
        "turns",
    )
    first = [F.get("turns", F.lit(i)) for i in range(WIDTH)]
    keyed = keyed.withColumns({name: turn["t"] for name, turn in zip(TURNS, first, strict=True)})
    for i in range(1, WIDTH):
        words = F.coalesce(first[i - 1]["words"], none)
        keyed = keyed.withColumn(f"w{i}", F.col(f"w{i - 1}") + words)
    last = F.col(f"w{WIDTH - 1}") + F.coalesce(first[-1]["words"], none)
    return temp(keyed.withColumn("w_end", last).drop("turns"), "blocks")


def _node_key(prior: str, own: int, depth: Column, level: Column, upto: int = 0) -> Column:
    """The key of the node at ``level`` of a block, or of the one ``upto`` levels above."""
    key = F.col(prior)
    for i, turn in enumerate(TURNS, 1):
        place = F.col("block") * WIDTH + i
        part = _hashes(place, F.col(turn))[own]
        key = key.bitwiseXOR(F.when(level - upto >= i, part).otherwise(F.lit(0).cast("long")))
    return key


def _rollup(blocks: DataFrame, measures: str) -> DataFrame:
    """All prefixes at once: ``level`` is the number of turns of the block in the prefix."""
    turns = ", ".join(TURNS)
    rolled = blocks.sparkSession.sql(
        f"""SELECT block, kx, ky, {turns}, min(conv_id) AS conv_id, {measures},
                   {WIDTH} - CAST(bit_count(grouping_id()) AS INT) AS level
            FROM {{blocks}} GROUP BY block, kx, ky, ROLLUP({turns})""",
        blocks=blocks,
    )
    # A level that a conversation does not reach has a NULL turn; level 0 of a later block
    # is the last level of the block before.
    reached = F.coalesce(*[F.when(F.col("level") == i, F.col(t).isNotNull()) for i, t in enumerate(TURNS, 1)], F.col("block") == 0)
    return rolled.where(reached).withColumn("depth", F.col("block") * WIDTH + F.col("level"))


def _nodes(blocks: DataFrame, temp: Temporary) -> DataFrame:
    """Depth, smallest member, members, keys of the node and of its parent, words above."""
    least = ", ".join(f"min({w}) AS {w}" for w in WORDS)
    rolled = _rollup(blocks, f"count(1) AS n_convs, {least}")
    level = F.col("level")
    above = F.coalesce(*[F.when(level == i, F.col(f"w{i - 1}")) for i in range(1, WIDTH + 1)], F.lit(0).cast("long"))
    nodes = rolled.select(
        "depth",
        "conv_id",
        "n_convs",
        above.alias("words_above"),
        _node_key("kx", 0, F.col("depth"), level).alias("x"),
        _node_key("ky", 1, F.col("depth"), level).alias("y"),
        _node_key("kx", 0, F.col("depth"), level, 1).alias("px"),
        _node_key("ky", 1, F.col("depth"), level, 1).alias("py"),
    )
    nodes = temp(nodes, "nodes")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")]
    children = nodes.where("depth > 0").groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children"))
    return temp(
        nodes.join(children, ["depth", "x", "y"], "left").fillna(0, ["n_children"]), "nodes-children"
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, which come sorted by node and chunk."""
    key, state = None, None

    def row() -> pa.RecordBatch:
        values = [*key, state.hexdigest()]
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, types, strict=True)], names=["depth", "x", "y", "ends_sha256"]
        )

    for batch in batches:
        done = []
        for *node, ids in zip(*(column.to_pylist() for column in batch.columns[:4]), strict=True):
            if node != key:
                if key is not None:
                    done.append(row())
                key, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(f",{ids}".encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if key is not None:
        yield row()


def _ends(blocks: DataFrame) -> DataFrame:
    """The digest of the conversations that end at a node, by the node's depth and key."""
    last = blocks.where((F.col("total") == 0) | (F.col("block") == F.floor((F.col("total") - 1) / WIDTH)))
    level = F.col("total") - F.col("block") * WIDTH
    ends = last.select(
        F.col("total").alias("depth"),
        _node_key("kx", 0, F.col("total"), level).alias("x"),
        _node_key("ky", 1, F.col("total"), level).alias("y"),
        "conv_id",
        F.shiftright("conv_id", CHUNK_BITS).alias("chunk"),
    )
    # conv_id is distinct here, so a chunk has at most 2 ** CHUNK_BITS ids.
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = ends.groupBy("depth", "x", "y", "chunk").agg(F.concat_ws(",", ids).alias("ids"))
    chunks = chunks.repartition("depth", "x", "y").sortWithinPartitions("depth", "x", "y", "chunk")
    return chunks.select("depth", "x", "y", "ids").mapInArrow(
        _hashed, "depth long, x long, y long, ends_sha256 string"
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id``, ``depth`` and the contract's counts and sums."""
    with Temporary() as temp:
        blocks = _blocks(conversations, temp)
        nodes = _nodes(blocks, temp)

        # What each conversation owns: the nodes from its least depth on, and their words.
        chains = nodes.groupBy("conv_id").agg(
            F.min_by("words_above", "depth").alias("words_before"),
            (F.max_by("n_children", "depth") == 0).cast("long").alias("leaf"),
        )
        words = blocks.groupBy("conv_id").agg(F.max("w_end").alias("words"))
        owned = words.join(chains, "conv_id", "left").select(
            "conv_id",
            "words",
            F.coalesce(F.col("words") - F.col("words_before"), F.lit(0)).alias("own"),
            F.coalesce("leaf", F.lit(0)).alias("leaf"),
        )
        # One row per run of blocks, so that a long conversation is no hot key below.
        runs = blocks.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("n")).drop("n")
        owned = temp(runs.join(owned, "conv_id"), "owned")

        measured = blocks.join(owned, ["conv_id", "run"])
        sums = _rollup(measured, "sum(words) AS words_sum, sum(own) AS own_sum, sum(leaf) AS n_leaves")
        sums = sums.select("depth", "conv_id", "words_sum", "own_sum", "n_leaves")

        parents = nodes.where("n_children > 0").select(
            (F.col("depth") + 1).alias("depth"),
            F.col("x").alias("px"),
            F.col("y").alias("py"),
            F.col("conv_id").alias("parent_conv_id"),
            F.col("n_children").alias("n_rows"),
        )
        below = salted_lookup(
            nodes.where("depth > 0"), temp(parents, "parents"), ["depth", "px", "py"], "n_rows", "conv_id", min_piece=HOT_NODE
        )
        root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
        place = F.greatest(F.col("depth") - 1, F.lit(0))
        told = (
            below.unionByName(root)
            .join(_ends(blocks), ["depth", "x", "y"], "left")
            .join(sums, ["depth", "conv_id"])
            .withColumn("run", F.floor(F.floor(place / WIDTH) / RUN))
            .join(owned, ["conv_id", "run"])
        )
        passing = F.col("words_sum") - F.col("n_convs") * F.col("words_above")
        once = F.col("own_sum") - F.col("own") + F.col("words") - F.col("words_above")
        return stored(
            told.select(
                "conv_id",
                "depth",
                "parent_conv_id",
                "n_convs",
                "n_children",
                "n_leaves",
                (passing - once).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
            ),
            "trie",
        )


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP13_SQL = r"""
WITH source AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'role': role, 'text': text}
         ORDER BY turn NULLS FIRST, sha256(strlen(role)::VARCHAR || ':' || role || text)) AS turns
  FROM source GROUP BY conv_id),
headed AS (
  SELECT *, (xor(4294967295, list_reduce(
      list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
        lambda state, step: CASE WHEN state % 2 = 1 THEN xor(state // 2, 3988292384) ELSE state // 2 END,
        xor(crc, byte)),
      4294967295::BIGINT)) % 4)::INT AS h
  FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
path AS (
  SELECT conv_id, d, len(turns) AS n, turns[1:d] AS prefix,
         CASE WHEN d = 0 THEN 0
              ELSE len(regexp_extract_all(turns[d].text, '[^\x20\x09-\x0D]+')) END AS words
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1))::BIGINT AS d FROM rebuilt)),
named AS (SELECT *, min(conv_id) OVER (PARTITION BY d, prefix) AS node FROM path),
linked AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS parent FROM named),
nodes AS (
  SELECT d, node, any_value(parent) AS parent, count(*) AS n_convs, any_value(words) AS words,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
  FROM linked GROUP BY d, node),
children AS (SELECT d - 1 AS d, parent AS node, count(*) AS k FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(k, 0) AS k FROM nodes n LEFT JOIN children USING (d, node)),
below AS (
  SELECT DISTINCT a.d, a.node, b.d AS sub_d, b.node AS sub_node
  FROM named a JOIN named b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (
  SELECT b.d, b.node, count(*) FILTER (WHERE f.k = 0) AS n_leaves, sum((f.n_convs - 1) * f.words) AS saved
  FROM below b JOIN full_nodes f ON f.d = b.sub_d AND f.node = b.sub_node GROUP BY ALL)
SELECT node AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, k AS n_children,
       n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM full_nodes JOIN sums USING (d, node)
"""
