"""Personal data by weak supervision, in DataFrame functions only.

Base spans are fixed patterns with fixed checks; they always stay.  Candidates are
all pattern hits, also those that fail their check, and hits of more patterns.  Four
labelers vote for, against, or abstain on each candidate: its format (regex and
checksum), a gazetteer of known endings, prefixes and codes, cue words before it, and
how it is set apart from its neighbours.  Candidates are counted by kind and votes, at
most ``81`` patterns a kind, and expectation-maximisation estimates from these counts
how reliable each labeler is.  Its posteriors are the soft labels of a naive Bayes
classifier over span features, which decides on the spans that are added.

Places are found from the lengths of the pieces around the hits, so a text is only
scanned and never indexed.  The patterns are written so that a text of any length
takes linear time and no stack: runs start after a character outside the run, and
quantifiers that are followed by another class are possessive.

Cases: NULL text is empty; a kind without candidates adds nothing; rows repeated get
the same result each; rows of one doc_id with other texts are judged each for itself;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passbook.llm.tables import stored

KINDS = ("email", "ip", "card", "phone", "local_phone", "ssn", "secret")
BASE = KINDS[:4]
LABELERS = 4
VOTES = 3  # against, for, abstain
PATTERNS = VOTES**LABELERS
FEATURES = 512  # feature numbers of one kind
ROUNDS = 25
# Chances of the votes against, for and abstain on other text, then on personal data.
# They weigh as much as TRUST times all candidates, at every size of the corpus, so that
# the two classes cannot change places.
BELIEF = "array(0.6D, 0.2D, 0.2D, 0.1D, 0.6D, 0.3D)"
TRUST = 0.25
SURE = 0.9
CONTEXT = 40
CHUNK = 256

# The base patterns, in a form that runs in linear time.
_LOCAL = "A-Za-z0-9._%+-"
PATTERN = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "local_phone": r"(?<!\+[0-9]{1,3}[ .-]?)(?<![0-9+.(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![0-9A-Za-z_])(?:[0-9a-f]{32,}+|AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36})(?![0-9A-Za-z_])",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
OCTETS = rf"^{_PART}(?:\.{_PART}){{3}}$"

# Gazetteers and cue words.
KNOWN = {
    "email": r"\.(?:com|org|net|edu|gov|io|info|eu|de|fr|es|uk)$",
    "ip": r"^(?!0+\.|127\.|22[4-9]\.|23[0-9]\.|24[0-9]\.|25[0-5]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36)",
    "phone": r"^\+(?:1|7|20|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1-6]|9[0-8])(?![0-9]{0,1}$)",
    "local_phone": r"^\(?[2-9]",
    "ssn": r"^(?!000|666|9[0-9][0-9])[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "secret": r"^(?:AKIA|ghp_)|[0-9].*[a-f]|[a-f].*[0-9]",
}
CUES = {
    "email": r"mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|address|login|adresse",
    "card": r"card|visa|master|amex|payment|karte|carte|tarjeta",
    "phone": r"phone|call|tel|mobile|fax|anruf",
    "local_phone": r"phone|call|tel|mobile|fax|anruf",
    "ssn": r"ssn|social|security|tax",
    "secret": r"token|key|secret|password|api|auth",
}
AGAINST = r"version|isbn|issue|section|invoice|figure|page\b"


def _ends() -> Column:
    """Where each hit ends: running sums of ``sizes``, in chunks, so that long lists
    are not copied once per element."""
    return F.expr(f"""
      flatten(transform(
        aggregate(
          transform(sequence(0, (size(sizes) + {CHUNK - 1}) div {CHUNK}),
                    c -> aggregate(slice(sizes, cast(c * {CHUNK} + 1 as int), {CHUNK}), 0L, (a, x) -> a + x)),
          named_struct('at', 0L, 'starts', cast(array() as array<bigint>)),
          (acc, x) -> named_struct('at', acc.at + x, 'starts', concat(acc.starts, array(acc.at)))
        ).starts,
        (s, c) -> aggregate(
          slice(sizes, c * {CHUNK} + 1, {CHUNK}),
          named_struct('at', s, 'ends', cast(array() as array<bigint>)),
          (acc, x) -> named_struct('at', acc.at + x, 'ends', concat(acc.ends, array(acc.at + x)))
        ).ends))
    """)


def hits(texts: DataFrame, kind: str) -> DataFrame:
    """``texts`` (``key``, ``text``, ...) with the array ``<kind>_hits`` of spans."""
    pattern = F.lit(PATTERN[kind])
    own = [c for c in texts.columns]
    found = texts.withColumn("values", F.regexp_extract_all("text", pattern, F.lit(0)))
    found = found.withColumn(
        "parts", F.when(F.size("values") > 0, F.split("text", PATTERN[kind], -1))
    )
    found = found.withColumn(
        "sizes",
        F.transform(
            "values", lambda v, i: (F.length(v) + F.length(F.get(F.col("parts"), i))).cast("long")
        ),
    ).withColumn("ends", F.when(F.size("values") > 0, _ends()))

    def span(value: Column, i: Column) -> Column:
        end = F.get(F.col("ends"), i)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            (end - F.length(value)).alias("start"),
            end.alias("end"),
            value.alias("value"),
            F.right(F.get(F.col("parts"), i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(F.col("parts"), i + 1), F.lit(1)).alias("after"),
        )

    return found.select(*own, F.transform("values", span).alias(f"{kind}_hits"))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    values = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))),
        lambda i: F.substring(back, i, F.lit(1)).cast("int")
        * F.when(i % 2 == 0, F.lit(2)).otherwise(F.lit(1)),
    )
    total = F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v))
    return total % 10 == 0


def _by_kind(choices: dict[str, Column]) -> Column:
    chosen = None
    for kind, column in choices.items():
        here = F.col("kind") == KINDS.index(kind)
        chosen = F.when(here, column) if chosen is None else chosen.when(here, column)
    return chosen


def valid() -> Column:
    """Whether a hit of columns ``kind`` and ``value`` passes the check of its kind."""
    value = F.col("value")
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return _by_kind(
        {
            "email": F.lit(True),
            "ip": value.rlike(OCTETS),
            "card": F.when(n.between(12, 19), _luhn(digits)).otherwise(F.lit(False)),
            "phone": n.between(9, 15),
            "local_phone": F.lit(True),
            "ssn": F.lit(True),
            "secret": F.length(value) < 129,
        }
    )


def plausible() -> Column:
    n = F.length(F.regexp_replace("value", "[^0-9]", ""))
    return _by_kind({k: F.lit(True) for k in KINDS} | {"card": n.between(12, 19), "phone": n.between(7, 17)})


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(2)


def _class(char: Column) -> Column:
    """0 nothing, 1 white space, 2 letter, 3 digit, 4 other."""
    empty = F.coalesce(char, F.lit("")) == ""
    return (
        F.when(empty, 0)
        .when(char.rlike(r"^\s$"), 1)
        .when(char.rlike(r"^\p{L}$"), 2)
        .when(char.rlike("^[0-9]$"), 3)
        .otherwise(4)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """All hits with ``base``, the number of their vote pattern, and feature numbers."""
    text = F.coalesce("text", F.lit(""))
    key = F.struct("doc_id", F.xxhash64("text").alias("version")).alias("key")
    found = docs.select(key, text.alias("text"))
    for kind in KINDS:
        found = hits(found, kind)
    spans = found.select(
        "key", F.explode(F.concat(*[F.col(f"{kind}_hits") for kind in KINDS])).alias("span")
    ).select("key", "span.*")
    before = F.lower("before")
    left, right = _class(F.right("before", F.lit(1))), _class(F.col("after"))
    # Digits that cannot be a card or a number for their count are no candidates.
    spans = spans.where(plausible()).withColumn("valid", valid())
    spans = spans.select(
        "key",
        "kind",
        "start",
        "end",
        (F.col("valid") & (F.col("kind") < len(BASE))).alias("base"),
        _vote(F.col("valid"), ~F.col("valid")).alias("format"),
        _vote(_by_kind({k: F.col("value").rlike(KNOWN[k]) for k in KINDS}), F.lit(True)).alias("known"),
        _vote(_by_kind({k: before.rlike(CUES[k]) for k in KINDS}), before.rlike(AGAINST)).alias("cue"),
        _vote((left < 2) & (right < 2), (left == 2) | (left == 3) | (right == 2) | (right == 3)).alias("apart"),
        F.least(F.length("value"), F.lit(63)).alias("f_length"),
        (64 + 5 * left + right).alias("f_sides"),
        (96 + F.least(F.length(F.regexp_replace("value", "[0-9A-Za-z]", "")), F.lit(15))).alias("f_marks"),
        (112 + F.least(F.length(F.regexp_replace("value", "[^0-9]", "")), F.lit(31))).alias("f_digits"),
        (256 + F.pmod(F.xxhash64(F.regexp_extract(before, r"(\p{L}+)\P{L}*$", 1)), F.lit(256)).cast("int")).alias("f_word"),
    )
    votes = [F.col(name) for name in ("format", "known", "cue", "apart")]
    pattern = F.col("kind") * PATTERNS
    for at, vote in enumerate(votes):
        pattern = pattern + vote * VOTES ** (LABELERS - 1 - at)
    features = [F.col(f"f_{name}") for name in ("length", "sides", "marks", "digits", "word")]
    return spans.select(
        "key",
        "kind",
        "start",
        "end",
        "base",
        pattern.alias("pattern"),
        F.transform(F.array(*features), lambda f: f + F.col("kind") * FEATURES).alias("features"),
    )


def _posteriors(found: DataFrame) -> DataFrame:
    """One row with the array ``posterior``: of each vote pattern, that it is personal.

    A two-class model with independent labelers, fitted to the counts of patterns of
    each kind; at most ``PATTERNS`` counts a kind whatever the corpus.
    """
    counts = found.groupBy("pattern").agg(F.count(F.lit(1)).cast("double").alias("n"))
    by_kind = counts.groupBy(F.expr(f"cast(pattern div {PATTERNS} as int)").alias("kind")).agg(
        F.sort_array(F.collect_list(F.struct((F.col("pattern") % PATTERNS).alias("p"), "n"))).alias("seen")
    )

    def vote(p: str, labeler: str) -> str:
        power = f"element_at(array(27, 9, 3, 1), cast({labeler} + 1 as int))"
        return f"cast(({p} div {power}) % 3 as int)"

    def chance(p: str, model: str) -> str:
        ratio = " + ".join(
            f"ln({model}.chances[{6 * at + 3} + {vote(p, str(at))}] / {model}.chances[{6 * at} + {vote(p, str(at))}])"
            for at in range(LABELERS)
        )
        return f"1 / (1 + exp(-(ln({model}.prior / (1 - {model}.prior)) + {ratio})))"

    weight = "x.n * (CASE WHEN (j div 3) % 2 = 1 THEN x.r ELSE 1 - x.r END)"
    all_ = f"{TRUST} * aggregate(rs, 1D, (a, x) -> a + x.n)"
    mine = f"CASE WHEN {vote('x.p', '(j div 6)')} = j % 3 THEN {weight} ELSE 0D END"
    step = f"""
      transform(array(transform(seen, x -> named_struct('p', x.p, 'n', x.n, 'r', {chance('x.p', 'm')}))),
        rs -> named_struct(
          'prior', (1 + aggregate(rs, 0D, (a, x) -> a + x.n * x.r)) / (2 + aggregate(rs, 0D, (a, x) -> a + x.n)),
          'chances', transform(sequence(0, {6 * LABELERS - 1}), j ->
            ({all_} * {BELIEF}[j % 6] + aggregate(rs, 0D, (a, x) -> a + {mine}))
            / ({all_} + aggregate(rs, 0D, (a, x) -> a + {weight})))
        ))[0]
    """
    start = f"named_struct('prior', 0.5D, 'chances', flatten(array_repeat({BELIEF}, {LABELERS})))"
    fitted = by_kind.withColumn("model", F.expr(f"aggregate(sequence(1, {ROUNDS}), {start}, (m, i) -> {step})"))
    table = fitted.select(
        "kind",
        F.expr(f"transform(sequence(0, {PATTERNS - 1}), p -> {chance('p', 'model')})").alias("chances"),
    )
    return _by_number(table.select("kind", "chances"), PATTERNS)


def _by_number(table: DataFrame, size: int) -> DataFrame:
    """The arrays of all kinds end to end, zeros where a kind is missing."""
    whole = table.agg(F.map_from_entries(F.collect_list(F.struct("kind", "chances"))).alias("m"))
    return whole.select(
        F.expr(
            f"flatten(transform(sequence(0, {len(KINDS) - 1}),"
            f" k -> coalesce(m[k], array_repeat(0D, {size}))))"
        ).alias("values")
    )


def _weights(labelled: DataFrame) -> DataFrame:
    """One row with the log odds of every feature number, from the soft labels."""
    each = labelled.select("kind", F.explode("features").alias("feature"), "label")
    sums = each.groupBy("kind", "feature").agg(
        F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no")
    )
    totals = labelled.groupBy("kind").agg(F.sum("label").alias("all_yes"), F.sum(1 - F.col("label")).alias("all_no"))
    odds = sums.join(totals, "kind").select(
        "kind",
        (F.col("feature") % FEATURES).alias("slot"),
        (
            F.ln((F.col("yes") + 0.5) / (F.col("all_yes") + 1))
            - F.ln((F.col("no") + 0.5) / (F.col("all_no") + 1))
        ).alias("odds"),
        F.ln((F.col("all_yes") + 0.5) / (F.col("all_no") + 0.5)).alias("prior"),
    )
    by_kind = odds.groupBy("kind").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "odds"))).alias("m"), F.first("prior").alias("prior")
    )
    # The last number of a kind holds its prior.
    slots = F.expr(
        f"transform(sequence(0, {FEATURES - 1}),"
        f" j -> CASE WHEN j = {FEATURES - 1} THEN prior ELSE coalesce(m[j], 0D) END)"
    )
    return _by_number(by_kind.select("kind", slots.alias("chances")), FEATURES)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts and digest of the base spans, and all spans."""
    found = stored(candidates(docs), "candidates")
    posterior = stored(_posteriors(found), "posteriors").scalar()
    labelled = found.withColumn("label", F.get(posterior, F.col("pattern")))
    weights = stored(_weights(labelled), "weights").scalar()
    number = lambda f: F.get(weights, f)
    prior = number(F.col("kind") * FEATURES + FEATURES - 1)
    score = prior
    for at in range(5):
        score = score + number(F.get("features", F.lit(at)))
    # A span is added when labelers and classifier agree that it is personal.
    added = (score > 0) & (F.col("label") > SURE)
    names = F.array(*[F.lit(kind) for kind in KINDS])
    spans = found.withColumn("label", F.get(posterior, F.col("pattern"))).where(F.col("base") | added)
    per_text = spans.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("start", "kind", "end", "base"))).alias("spans")
    )
    row = docs.select("doc_id", F.struct("doc_id", F.xxhash64("text").alias("version")).alias("key"))
    joined = row.join(per_text, "key", "left")
    all_ = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,base:boolean>>"))
    base = F.filter(all_, lambda s: s.base)

    def listed(which: Column) -> Column:
        told = F.transform(which, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end))
        return F.array_join(told, ",")


    def of_kind(k: int) -> Column:
        return F.size(F.filter(base, lambda s: s.kind == k)).cast("long")

    counts = [of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    return joined.select(
        "doc_id",
        *counts,
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(all_).alias("spans"),
    )


def op5_pii(spark, sf_dir: str) -> DataFrame:
    return find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
