"""Every text query against plain Python, on odd rows, real rows and empty tables."""

from __future__ import annotations

import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from passbook.llm import decontaminate, language, line_dedup, minhash, mixing, prefix_trie, registry, resampling, token_counts, token_output
from passbook.session import shared_dir
from passbook.sources.folders import sub_folders
from tests.compare import connect, difference
from tests.llm import brute

QUERIES = registry.queries()
FULL = {
    "op1_line_dedup": (
        ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        lambda rows, items, hosts: brute.lines(hosts, line_dedup.RATIO, line_dedup.LEAST_PAGES),
    ),
    "op4_minhash_near_dedup": (
        ["doc_id", "n_shingles", "component_id", "kept"],
        lambda rows, items, hosts: brute.near(rows),
    ),
    "op5_pii": (
        ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"],
        lambda rows, items, hosts: brute.personal(rows),
    ),
    "op6_best_fit_packing": (
        ["doc_id", "piece", "start", "length", "ids_crc32"],
        lambda rows, items, hosts: brute.token_pieces(rows),
    ),
    "op8_decontamination": (
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items"],
        lambda rows, items, hosts: brute.contamination(rows, items),
    ),
    "op9_substring_dedup": (
        ["doc_id", "n_words", "n_removed", "kept_sha256"],
        lambda rows, items, hosts: brute.repeats(rows),
    ),
    "op12_importance_resampling": (
        ["doc_id", "n_features", "weight", "score", "rank"],
        lambda rows, items, hosts: brute.resampled(rows, items),
    ),
    "op10_exact_dedup": (
        ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
        lambda rows, items, hosts: brute.exact(rows),
    ),
}


def bag(df, columns) -> Counter:
    return Counter(tuple(row) for row in df.select(*columns).collect())


@pytest.mark.parametrize("name", FULL)
@pytest.mark.parametrize("table", ["odd", "real"])
def test_equals_brute_force(spark, request, name, table):
    path, rows, items, hosts = request.getfixturevalue(table)
    columns, want = FULL[name]
    got, wanted = bag(QUERIES[name](spark, path), columns), want(rows, items, hosts)
    assert got - wanted == Counter() and wanted - got == Counter()


@pytest.mark.parametrize("name", [name for name in QUERIES if name != "pipeline"])
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_matches_sql(spark, name):
    con = connect("/root/testdata/sf0.001")
    assert difference(spark, con, name, QUERIES[name], registry.oracle_sql()[name], "/root/testdata/sf0.001") is None


def test_added_spans_keep_the_base_ones(spark, odd):
    path, rows, *_ = odd
    texts = {doc_id: text for doc_id, text in rows}
    for row in QUERIES["op5_pii"](spark, path).collect():
        base = {f"{kind}:{start}:{end}" for start, _, end, kind in brute.base_spans(texts[row.doc_id])}
        assert base <= set(row.spans.split(","))


def test_secrets_are_added(spark):
    path = "/root/testdata/sf0.01"
    found = QUERIES["op5_pii"](spark, path).where("spans LIKE '%secret:%'")
    texts = dict(spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect())
    assert found.count() > 0
    assert all("token" in texts[row.doc_id] for row in found.collect())


@pytest.mark.parametrize("table", ["odd", "real"])
def test_sequences_are_gapless_and_few(spark, request, table):
    path = request.getfixturevalue(table)[0]
    packed = QUERIES["op6_best_fit_packing"](spark, path).toPandas().sort_values(["sequence_id", "offset"])
    by = packed.groupby("sequence_id")["length"]
    assert (by.cumsum() - packed["length"] == packed["offset"]).all()
    assert by.sum().max() <= 4096
    assert packed["sequence_id"].nunique() <= packed["length"].sum() / 4096 * 1.02 + 1


def test_language_on_held_out_rows(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang")
    told = QUERIES["op7_language_id"](spark, path).join(docs, "doc_id").where("held_out")
    right = told.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_language_of_odd_texts(spark, odd):
    path, rows, *_ = odd
    texts = dict(rows)
    got = QUERIES["op7_language_id"](spark, path).collect()
    assert len(got) == len(rows)
    for row in got:
        plain = texts[row.doc_id] or ""
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in plain))
        assert 0 <= row.score <= 1


def test_counts_follow_edits(spark, odd):
    path, rows, *_ = odd
    got = {}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    told = QUERIES["op2_token_counts"](spark, path).collect()
    for row in token_counts.redactions(docs).collect():
        new = brute.edited(row.text, [tuple(e) for e in row.edits])
        got[row.doc_id] = len(brute.token_ids(new)), len(brute.token_ids(row.text))
    assert len(told) == len(rows)
    for row in told:
        assert (row.n_tokens, row.n_tokens_before) == got[row.doc_id]


def test_any_edits_are_counted(spark):
    pick = np.random.default_rng(3)
    rows = []
    for k in range(120):
        text = " ".join(pick.choice(["ab", "c.", "é,", " ", "\n", "xyz", "1.5", "<|x"], pick.integers(0, 90)))
        at = pick.integers(-3, len(text) + 4, (pick.integers(0, 6), 2))
        edits = [(int(min(p)), int(max(p)), str(pick.choice(["", " ", "new", "a b", "."]))) for p in at]
        rows.append((k, text, edits))
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:long,end:long,text:string>>")
    path = token_counts.public_tokenizers.path(token_counts.TOKENIZER)
    want = {k: len(brute.token_ids(brute.edited(text, edits))) for k, text, edits in rows}
    got = {row.doc_id: row.n_tokens for row in token_counts.counts_after(docs, path).collect()}
    assert got == want


def test_shards_round_trip(spark, odd, tmp_path):
    path, rows, *_ = odd
    token_output.write_shards(QUERIES["op3_token_output"](spark, path), str(tmp_path / "shards"))
    back = token_output.read_from(spark, str(tmp_path / "shards")).collect()
    assert [row.slot for row in back] == list(range(len(back)))
    resumed = token_output.read_from(spark, str(tmp_path / "shards"), 5).collect()
    assert resumed == back[5:]
    want = Counter()
    for (doc_id, piece, _, length, _), n in brute.token_pieces(rows, token_output.STRIDE).items():
        want[doc_id, piece, length] += n
    assert want == Counter((row.doc_id, row.piece, len(row.ids) // 2) for row in back)
    texts = dict(rows)
    for row in back:
        ids = [*brute.token_ids(texts[row.doc_id]), 1][row.piece * token_output.STRIDE :][: token_output.STRIDE]
        assert np.frombuffer(bytes(row.ids), "<u2").tolist() == ids


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_feistel_is_a_bijection(size):
    slots = token_output.permuted(np.arange(size), size)
    assert sorted(slots.tolist()) == list(range(size))
    assert size < 64 or (np.diff(slots) == 1).mean() < 0.1


def _pipeline(rows, items):
    """The rows that reach the packing, by brute force."""
    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    groups = {}
    for r in sorted(kept, key=lambda r: (-len(r[1]), brute.first(r[0]))):
        groups.setdefault("".join(brute.WORD.findall(r[1])), r)
    kept = list(groups.values())
    stay = {row[0] for row in brute.near(kept) if row[3]}  # ids are distinct here
    kept = [r for r in kept if r[0] in stay or r[0] is None]
    bad = {row[0] for row in brute.contamination(kept, items) if row[5]}
    return [r for r in kept if r[0] not in bad]


@pytest.mark.parametrize("table", ["odd", "real"])
def test_pipeline(spark, request, table):
    path, rows, items, _ = request.getfixturevalue(table)
    got = corpus_pipeline.run(spark, path)
    want = brute.token_pieces(_pipeline(rows, items))
    assert bag(got, ["doc_id", "piece", "start", "length", "ids_crc32"]) == want


def test_stages_keep_columns(spark, odd):
    docs = spark.read.parquet(f"{odd[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, odd[0]).columns == docs.columns


def _shared_ids():
    """Texts under ids of their own and under ids that other texts have, too."""
    pick = np.random.default_rng(9)
    words = [f"w{k}" for k in range(40)]
    text = lambda: " ".join(pick.choice(words, 60))
    a, b, c, d = text(), text(), text(), text()
    near = lambda t, k: " ".join(t.split()[:-k] + ["other"] * k)
    rows = [(1, a), (5, a), (5, b), (7, near(b, 2)), (7, c), (7, near(a, 1)), (3, d), (3, near(d, 1)), (3, d)]
    return rows + [(9, ""), (9, None), (9, c), (None, a), (None, c)]


def test_texts_of_one_id_are_told_apart(spark):
    rows = _shared_ids()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = bag(minhash.near_duplicates(docs), ["doc_id", "n_shingles", "component_id", "kept"])
    assert got == brute.near(rows)


def test_near_dedup_stage_keeps_unrelated_texts_of_an_id(spark):
    rows = list(dict.fromkeys(_shared_ids()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    gone = set(rows) - kept
    texts = [t for d, t in kept if d is not None and brute.shingles(t)]
    for k, x in enumerate(texts):  # no near-duplicates are left
        for y in texts[:k]:
            both = len(brute.shingles(x) & brute.shingles(y))
            assert 100 * both < 75 * len(brute.shingles(x) | brute.shingles(y))
    assert rows[2] in kept and rows[0] in kept and rows[1] in gone
    assert all(d is not None and brute.shingles(t) for d, t in gone) and len(gone) == 5


@pytest.mark.parametrize("langs", [[None], ["und"], ["und", "en"]])
def test_language_stage_keeps_every_text_with_a_letter(spark, langs):
    texts = ["plain words of prose", "mehr davon hier", "12 34 !", "", None, "é"] * 10
    rows = [(k, text, langs[k % len(langs)]) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {row.doc_id for row in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert got == {k for k, text, _ in rows if any(c.isalpha() for c in text or "")}


def test_training_sample_is_bounded(spark):
    rows = [(1, f"same id, other text {chr(97 + k % 26) * (k // 26 + 1)}", "en") for k in range(200)]
    rows += [(2, "repeated row", "de")] * 2000 + [(k, f"eigener Text {chr(97 + k % 26) * 9}", "de") for k in range(3, 60)]
    rows += [(k, "lang " * 9000, "nl") for k in range(100, 110)] + [(None, "no id", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.training_sample(docs, docs_per_language=20, doc_bytes=1000).collect()
    assert Counter(row.lang for row in got) == {"en": 20, "de": 20, "nl": 10, "fr": 1}
    assert max(len(row.text) for row in got) == 1000
    assert sum(row.text == "repeated row" for row in got) <= 1


TRIE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


@pytest.mark.parametrize("table", ["odd", "real"])
@pytest.mark.parametrize("run", [2, prefix_trie.RUN])
def test_trie_equals_brute_force(spark, request, monkeypatch, table, run):
    monkeypatch.setattr(prefix_trie, "RUN", run)
    path = request.getfixturevalue(table)[0]
    turns = spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got, want = bag(QUERIES["op13_prefix_trie"](spark, path), TRIE), brute.trie([tuple(t) for t in turns])
    assert got - want == Counter() and want - got == Counter()


def test_trie_with_hot_nodes_and_small_chunks(spark, odd, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HOT_NODE", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 1)
    turns = spark.read.parquet(f"{odd[0]}/conversations.parquet")
    want = brute.trie([tuple(t) for t in turns.select("conv_id", "turn", "role", "text").collect()])
    assert bag(prefix_trie.prefix_trie(turns), TRIE) == want


def test_features_are_all_runs_of_words():
    words, buckets = resampling.feature_buckets("Ab, ab\u00e9--C1  x".encode())
    runs = ["ab", "ab\u00e9", "c1", "x", "ab ab\u00e9", "ab\u00e9 c1", "c1 x", "ab ab\u00e9 c1", "ab\u00e9 c1 x"]
    assert words == 4 and sorted(buckets.tolist()) == sorted(brute.zlib.crc32(r.encode()) % 10000 for r in runs)


def test_every_row_is_ranked_once(spark):
    text = "one two three four five six seven eight nine ten " * 3
    rows = [(k % 7 if k % 3 else 5, text) for k in range(1000)] + [(None, text)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = resampling.resample(docs, docs.limit(0), percent=30).where("rank IS NOT NULL")
    ranks = [row["rank"] for row in got.orderBy("rank").collect()]
    assert ranks == list(range(1, 1050 * 30 // 100 + 1))


def _order(row):
    return tuple((value is not None, value or 0) for value in row[:6])


@pytest.mark.parametrize("table", ["odd", "real"])
@pytest.mark.parametrize("hot", [3, mixing.HOT])
def test_base_scores_equal_brute_force(spark, request, monkeypatch, table, hot):
    monkeypatch.setattr(mixing, "HOT", hot)
    monkeypatch.setattr(mixing, "WORDS_IN_TASK", 50)
    path, rows, *_ = request.getfixturevalue(table)
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    got = sorted((tuple(r) for r in QUERIES["op11_context_mixing"](spark, path).select(*columns).collect()), key=_order)
    want = sorted(brute.base_scores(rows), key=_order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def test_mixing_equals_bit_by_bit(monkeypatch):
    pick = np.random.default_rng(5)
    words = ["the", "an", "\u00e9a", "tion", "x1", "\n", "\x00", "longerthantwelvebytes"]
    texts = [" ".join(pick.choice(words, pick.integers(0, 60))).encode() for _ in range(12)]
    counts = mixing._Counts()
    counts.add([part for text in texts[:9] for part in mixing.segments(text)])
    tables = np.stack([mixing.votes(c).view(np.uint32).ravel() for c in counts.cells])
    monkeypatch.setattr(mixing, "SEGMENT", 100)
    got = [mixing.code_lengths(list(mixing.segments(text)), tables).sum() for text in texts]
    together = [part for text in texts for part in mixing.segments(text)]
    assert np.isclose(mixing.code_lengths(together, tables).sum(), sum(got), rtol=1e-6)
    assert np.allclose(got, [brute.code_length(text, tables) for text in texts], rtol=1e-3)


def test_mixing_is_a_probability():
    """Over every next byte the probabilities add up to one, less what escapes that are
    never written would take: those of frequent bytes."""
    counts = np.random.default_rng(1).integers(0, 4, (mixing.PREDICTORS, 1 << mixing.SLOT_BITS))
    tables = np.stack([mixing.votes(c).view(np.uint32).ravel() for c in counts])
    before = bytes(mixing.LOOK_BACK) + b"some text"
    lengths = mixing.code_lengths([before + bytes([c]) for c in range(256)], tables)
    start = mixing.code_lengths([before], tables)
    assert 0.9 < np.exp2(start - lengths).sum() <= 1 + 1e-3


def test_vote_tables_add_up(spark, odd):
    docs = spark.read.parquet(f"{odd[0]}/documents.parquet").select("text")
    counts = mixing._Counts()
    for row in docs.collect():
        for part in mixing.segments((row.text or "").encode().lower()):
            counts.add([part])
    salted = docs.repartition(5).select("text", (F.spark_partition_id() % 3).alias("salt"))
    tables = mixing.vote_tables(salted.mapInArrow(mixing._count, mixing.COUNTED))
    want = np.stack([mixing.votes(c).view(np.uint32).ravel() for c in counts.cells])
    # A vote of a context that was never met is read by no text of the table.
    assert (tables == want)[counts.cells > 0].all()


def test_scores_beat_the_base_on_held_out_rows(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text")
    told = QUERIES["op11_context_mixing"](spark, path).where("held_out").join(docs, "doc_id")
    row = told.agg(
        F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum(F.octet_length("text")).alias("size")
    ).first()
    assert row.score > row.base and -row.score / np.log10(2) / row["size"] < 3


def test_checking_a_long_text_takes_time_in_proportion(spark):
    """One-word items align everywhere; words are compared block by block."""
    docs = lambda n: spark.createDataFrame([(1, "one two " * n), (2, "other")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one"), (2, "two one two one two")], "item_id long, text string")
    for n in (1, 700, 20_000):
        row = decontaminate.decontaminate(docs(n), items).where("doc_id = 1").first()
        want = brute.contamination([(1, "one two " * n), (2, "other")], [(1, "one"), (2, "two one two one two")])
        assert (1, *row[2:6], row.contaminated, row.n_near_items) in want


def test_code_lengths_equal_plain_ppm(monkeypatch):
    samples = {
        "en": [b"the cat sat on the mat", b"then that", b"a"],
        "de": [b"die katze sass auf der matte", "sch\u00f6n".encode()],
        "xx": [b"zzz"],
    }
    model = language.fit(samples)
    texts = [b"", b"the matte", b"qqq", "sch\u00f6n die".encode(), b"the cat sat on the mat" * 30, b"z"]
    want = [[brute.ppm_bits(samples, text)[name] for name in sorted(samples)] for text in texts]
    for size in (language.PIECE_BYTES, 64, 5, 1):
        monkeypatch.setattr(language, "PIECE_BYTES", size)
        assert np.allclose(model.code_lengths(texts), want, rtol=1e-5)


def test_memory_of_the_language_model_does_not_grow_with_a_text():
    model = language.fit({f"l{k}": [b"some words of language %d" % k] for k in range(12)})
    peaks = []
    for size in (1 << 20, 1 << 23):
        text = b"other words " * (size // 12)
        tracemalloc.start()
        model.code_lengths([text])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + 2 * (1 << 23)


def test_all_features_go_before_buckets_are_compared(spark, monkeypatch):
    seen = []
    components = minhash.components

    def look(links):
        app = spark.sparkContext.applicationId
        names = {name.rpartition("-")[0] for name in sub_folders(spark, f"{shared_dir(spark)}/{app}")}
        seen.append(names & {"features", "representatives"})
        return components(links)

    monkeypatch.setattr(minhash, "components", look)
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, text), (2, text), (3, text + " more")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 1}
    assert seen and all(names == {"representatives"} for names in seen)
