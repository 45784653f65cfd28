from __future__ import annotations

import random

import pytest
from pyspark.sql import SparkSession

from tests.conftest import spark  # noqa: F401

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, start string"
REAL = "/root/testdata/sf0.001"


def _rows() -> list[tuple]:
    """Copies, near copies, shared passages, odd texts, repeated rows and NULLs."""
    pick = random.Random(7)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "Ne", "pu", "éa", "the") for b in ("r", "st", "n.", "ß", "o,", "")]
    sentence = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    passage = sentence(60)
    texts: list[str | None] = [sentence(pick.randint(1, 120)) for _ in range(60)]
    texts += [texts[i] for i in range(0, 20, 2)]
    texts += [texts[i].replace(" ", "\n\t", 2) for i in range(0, 20, 4)]
    for i in range(20, 40):
        words = texts[i].split(" ")
        words[pick.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [f"{sentence(9)} {passage} {sentence(k)}" for k in range(8)]
    texts += [f"{passage[: 40 * k]} {sentence(20)}" for k in range(2, 8)]
    texts += [
        None,
        "",
        " \n\t ",
        "one",
        "one two three four",
        "ONE two Three four",
        "mail a.b@x.org, c@d.e.f. or a@b, x_@y.z@q.r 1.2.3.4 256.1.1.1 01.02.003.0004 1.2.3.4.5.6.7.8",
        "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500005555555559 +1 (771) 555-1655 +12 +49 30 1234567 .",
        "é@x.org +é 4111111111111111 ß 10.0.0.1.é\U0001f600 127.0.0.1",
        "<|endoftext|> <|ENDOFTEXT|> a.b c,d E.F 's'S don't ​ \x1c x́. ý,",
        "\x00 nul \x7f del",
        "1234567 89",
        "a" * 300 + "@" + "b.c" * 100,
        "ab " * 20_000,
        sentence(3000) + " " + passage,
        passage.upper(),
    ]
    rows = [(k, t, pick.choice(["en", "de", None]), f"s{k % 3}" if k % 5 else None, None, True, "x") for k, t in enumerate(texts)]
    rows += rows[:3] + rows[-4:-2]
    rows.append((None, texts[0], "en", "s0", None, None, None))
    return rows


def _items(rows: list[tuple]) -> list[tuple]:
    texts = [row[1] for row in rows]
    words = texts[1].split()
    return [
        (10, texts[85]),
        (9, " ".join(words[:14])),
        (2, "one two three"),
        (2, "one two three"),
        (3, None),
        (4, "!?"),
        (5, "nowhere to be seen"),
        (6, "one"),
        (None, "one two"),
    ]


CONVERSATIONS = "conv_id long, turn long, role string, text string, start string, depth int"


def _turns() -> list[tuple]:
    """Shared heads, copies, a long conversation, tied and NULL turns, few or no turns."""
    pick = random.Random(11)
    words = ["yes", "no ", " ok\t", "a b", "", "\x0bx", "é ß"]
    rows: list[tuple] = []
    for conv in [*range(-25, 3), *range(18, 64), 4096, 8191, 10**15]:
        for turn in range(pick.choice([1, 2, 3, 5, 9, 17])):
            rows.append((conv, turn, pick.choice(["user", "bot"]), pick.choice(words)))
    rows += [(conv, turn, "user", f"same {turn % 5}") for conv in range(70, 79) for turn in range(40)]
    rows += [(conv, turn, "user", f"long {turn % 7}") for conv in (80, 100, 101, 102) for turn in range(300 + conv)]
    rows += [(79, None, None, None), (79, None, None, None), (79, 3, None, "x"), (79, 3, "x", None)]
    rows += rows[:9] + [(None, 1, "user", "nobody"), (None, None, None, None)]
    return [(*row, "clash", 7) for row in rows]


@pytest.fixture(scope="session")
def odd(spark: SparkSession, tmp_path_factory):  # noqa: F811
    """A folder of small tables, and the rows of each."""
    path = tmp_path_factory.mktemp("odd")
    rows = _rows()
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{path}/documents.parquet")
    items = _items(rows)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(_turns(), CONVERSATIONS).repartition(3).write.parquet(f"{path}/conversations.parquet")
    return str(path), [(row[0], row[1]) for row in rows], items, [(row[0], row[3], row[1]) for row in rows]


@pytest.fixture(scope="session")
def empty(spark: SparkSession, tmp_path_factory):  # noqa: F811
    path = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], CONVERSATIONS).write.parquet(f"{path}/conversations.parquet")
    return str(path)


@pytest.fixture(scope="session")
def real(spark: SparkSession):  # noqa: F811
    docs = spark.read.parquet(f"{REAL}/documents.parquet").select("doc_id", "source", "text").collect()
    items = spark.read.parquet(f"{REAL}/benchmark.parquet").collect()
    plain = [(d.doc_id, d.text) for d in docs]
    return REAL, plain, [(i.item_id, i.text) for i in items], [(d.doc_id, d.source, d.text) for d in docs]
