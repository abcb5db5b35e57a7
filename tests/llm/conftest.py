import random

import pytest

WORDS = [
    a + b + c
    for a in ("ka", "lo", "mi", "ter", "sun")
    for b in ("ra", "ve", "no", "din", "pel")
    for c in ("s", "th", "ly", "ing", "or")
]


def prose(seed: int, words: int, line: int = 12) -> str:
    rng = random.Random(seed)
    out = [rng.choice(WORDS) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + line]) for i in range(0, words, line))


def changed(text: str, seed: int, every: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    return " ".join(rng.choice(WORDS) if rng.randrange(every) == 0 else w for w in words)


@pytest.fixture(scope="session")
def texts() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, shared passages, short, empty, null, long and repeated rows."""
    passage = prose(99, 40)
    rows: list[tuple[int | None, str | None]] = []
    for i in range(30):
        rows.append((i, prose(i, 60 + 7 * i)))
    for i in range(30, 45):
        rows.append((i, changed(prose(3, 120), i, 60)))
    for i in range(45, 55):
        rows.append((i, prose(7, 90) if i % 2 else prose(7, 90).upper()))
    for i in range(55, 70):
        rows.append((i, prose(i, 30) + "\n" + passage + "\n" + prose(i + 500, 20)))
    rows += [(70, ""), (71, None), (72, " \n\t "), (73, "one two"), (74, "One TWO"), (75, "x"), (76, "é" * 400)]
    rows += [(77, "a " * 3000), (78, prose(5, 6000, 40)), (79, "ÀÉ ünï"), (80, "\x00 nul \x00" * 9)]
    rows += [(20, prose(20, 60 + 140)), (5, prose(5, 95)), (81, prose(5, 95)), (82, prose(5, 95) + " tail")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With extra columns whose names clash with those the operators make."""
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    return frame.selectExpr(
        "doc_id", "text", "doc_id % 3 AS key", "'s' AS size", "1 AS n", "'x' AS sid", "doc_id AS component_id",
        "'w' AS word", "2 AS shard", "0 AS kept", "'d' AS digest", "1 AS place", "'p' AS part", "0.1 AS score",
    )


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
