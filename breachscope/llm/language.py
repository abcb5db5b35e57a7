"""Language of a text: sparse multinomial logistic regression on character n-grams.

Features are hashed n-grams of lower-cased characters, weighted by term frequency and
inverse document frequency and scaled to length one. The document frequencies are
counted over every row that may be learnt from. The weights are trained by the
follow-the-regularised-leader rule with an elastic-net penalty on a bounded sample of
labelled rows, and a temperature fitted on a further part of that sample makes the
scores honest. Sample and model are bounded (rows, features, labels); the model travels
with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breachscope.llm import kernel
from breachscope.session import settle

FEATURES = 1 << 16
GRAMS = (1, 2, 3)
SAMPLE_ROWS = 4000  # rows to train on, and a quarter as many for the temperature
# Features of the sample, all rows together, and labels that a model can tell apart.
SAMPLE_FEATURES = 16_000_000
MAX_LABELS = 256
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    idf: np.ndarray  # FEATURES
    weights: np.ndarray  # FEATURES x labels, sparse by the L1 penalty
    bias: np.ndarray
    temperature: float


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a blank after each, and where each text starts."""
    points = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return points, np.concatenate(([0], np.cumsum(lengths + 1)))


def feature_counts(rows: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and their counts of each row. Case, ASCII digits and runs of white space
    make no difference; n-grams are of characters, in any script, and do not cross rows."""
    points, row_start = _characters([r.decode("utf-8", "replace").lower() for r in rows])
    points[(points >= 48) & (points <= 57)] = 48
    points[(points >= 9) & (points <= 13)] = 32
    hashed = []
    running = np.zeros(len(points), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        size = max(len(points) - n + 1, 0)
        running = running[:size] * np.uint32(0x01000193) + points[n - 1 :] + np.uint32(n)
        if n in GRAMS:
            h = running * np.uint32(0x9E3779B1)
            hashed.append((h >> np.uint32(32 - FEATURES.bit_length() + 1)).astype(np.int32))
    for a, b in zip(row_start[:-1].tolist(), (row_start[1:] - 1).tolist(), strict=True):
        if b == a:
            yield np.zeros(0, np.int64), np.zeros(0)
            continue
        parts = [h[a : max(b - n + 1, a)] for n, h in zip(GRAMS, hashed, strict=True)]
        counts = np.bincount(np.concatenate(parts), minlength=FEATURES)
        found = np.flatnonzero(counts)
        yield found, counts[found]


def _vector(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[found]
    norm = np.sqrt((values * values).sum())
    return values / norm if norm else values


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(
    vectors: list[tuple[np.ndarray, np.ndarray]],
    targets: np.ndarray,
    labels: int,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.02,
    epochs: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader, one row at a time.

    Only the coordinates a row has are looked at: their weights follow from the sums
    of gradients ``z`` and of squared gradients ``n`` when they are needed, and are
    exactly zero where the L1 penalty outweighs the evidence."""
    z = np.zeros((FEATURES + 1, labels))
    n = np.zeros((FEATURES + 1, labels))

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(zi) <= l1] = 0
        return w

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(vectors)):
            found, values = vectors[i]
            at = np.append(found, FEATURES)
            x = np.append(values, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[targets[i]] -= 1
            g = x[:, None] * p
            squared = n[at] + g * g
            z[at] += g - (np.sqrt(squared) - np.sqrt(n[at])) / alpha * w
            n[at] = squared
    w = weights(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def calibrate(logits: np.ndarray, targets: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood."""
    if not len(logits):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(10), 80))
    rows = np.arange(len(targets))
    loss = [-np.log(_softmax(logits / t)[rows, targets] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _document_frequencies(texts: DataFrame) -> np.ndarray:
    """Over all rows. Each task sends its sums once, as one array."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for _, rows in kernel.text_blocks(batch.column(0)):
                for found, _ in feature_counts(rows):
                    sums[found] += 1
                    sums[-1] += 1
        if sums[-1]:
            width = 1 << 10
            cut = [sums[i : i + width] for i in range(0, FEATURES + 1, width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cut)), pa.int32()), pa.array([c.tolist() for c in cut])],
                names=["part", "sums"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}  # 65 parts at most
        for batch in batches:
            for part, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals[part] = totals.get(part, 0) + np.array(values, np.int64)
        if totals:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(totals), pa.int32()),
                    pa.array([t.tolist() for t in totals.values()], pa.list_(pa.int64())),
                ],
                names=["part", "sums"],
            )

    kind = "part int, sums array<long>"
    parts = texts.mapInArrow(count, kind).repartition("part").mapInArrow(add, kind).collect()
    total = np.zeros(FEATURES + 1, np.int64)
    for r in parts:
        total[r["part"] << 10 : (r["part"] << 10) + len(r["sums"])] = r["sums"]
    return total


def fit(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    sample_features: int = SAMPLE_FEATURES,
) -> Model | None:
    """Learn from the rows where ``learn`` holds and text and label are known.

    The sample is drawn by a hash of the row, evenly over the labels, whatever the
    order of the input: ``sample_rows`` rows and a quarter as many for the temperature,
    fewer where their features are more than ``sample_features`` in all. More than
    ``MAX_LABELS`` labels are refused. None when no such row exists."""
    usable = docs.where(learn & F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).alias("label")
    )
    totals = {r["label"]: r["count"] for r in usable.groupBy("label").count().limit(MAX_LABELS + 1).collect()}
    if not totals:
        return None
    if len(totals) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels to learn")
    labels = tuple(sorted(totals))
    df = _document_frequencies(usable.select("text"))
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    # A threshold on the hash leaves about the wanted number of rows of each label.
    wanted = sample_rows * 5 // 4
    share = F.create_map(
        *[F.lit(x) for k in labels for x in (k, min(1.0, 1.3 * wanted / len(labels) / totals[k]))]
    )
    place = F.pmod(F.xxhash64(F.lit(5), "doc_id", "label"), F.lit(1_000_003)) / 1_000_003.0
    chosen = usable.where(place < share[F.col("label")]).select(
        "label", "text", F.xxhash64(F.lit(6), "doc_id", F.crc32(F.col("text").cast("binary"))).alias("h")
    )

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = kernel.byte_rows(batch.column(1))
            for a, b in kernel.blocks(rows):
                found, counts = [], []
                for f, c in feature_counts(rows[a:b]):
                    found.append(f.astype("<i4").tobytes())
                    counts.append(c.astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                     pa.array(found, pa.binary()), pa.array(counts, pa.binary())],
                    names=["label", "h", "found", "counts"],
                )

    def learn_all(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("h").to_numpy(), kind="stable")
        index = {k: i for i, k in enumerate(labels)}
        vectors, targets = [], []
        names = table.column("label").to_pylist()
        found, counts = table.column("found").to_pylist(), table.column("counts").to_pylist()
        for i in order[:wanted].tolist():
            f = np.frombuffer(found[i], "<i4").astype(np.int64)
            vectors.append((f, _vector(f, np.frombuffer(counts[i], "<i4").astype(float), idf)))
            targets.append(index[names[i]])
        targets = np.array(targets)
        cut = max(1, len(vectors) * 4 // 5)
        weights, bias = train(vectors[:cut], targets[:cut], len(labels))
        logits = np.array([v @ weights[f] + bias for f, v in vectors[cut:]])
        temperature = calibrate(logits, targets[cut:])
        return pa.table(
            {
                "weights": [weights.astype("<f4").tobytes()],
                "bias": [bias.astype("<f8").tobytes()],
                "temperature": [temperature],
            }
        )

    # The limit holds where repeated rows share one hash and all pass the threshold.
    rows = settle(chosen.orderBy("h").limit(wanted).mapInArrow(sample, "label string, h long, found binary, counts binary"))
    # Short rows only: where in the order of the hashes the features are too many.
    upto = F.sum(F.octet_length("found") / 4).over(Window.orderBy("h"))
    least, last = (
        rows.select("h", upto.alias("upto"))
        .agg(F.min("h"), F.max(F.when(F.col("upto") <= sample_features, F.col("h"))))
        .first()
    )
    # The sample is bounded, so one task can train on it.
    trained = (
        rows.where(F.col("h") <= F.lit(least if last is None else last))
        .groupBy().applyInArrow(learn_all, "weights binary, bias binary, temperature double")
    ).collect()[0]
    return Model(
        labels,
        idf.astype(np.float32),
        np.frombuffer(trained["weights"], "<f4").reshape(FEATURES, len(labels)),
        np.frombuffer(trained["bias"], "<f8"),
        trained["temperature"],
    )


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score``.

    Null texts and texts without a letter are ``und`` with the score 0, as is every
    text when there was nothing to learn from. Scores are calibrated probabilities;
    of equal ones the label first in the alphabet wins. Columns of ``docs`` by these
    two names are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    if model is None:
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(vars(model))  # of a fixed size
    n = len(kept)
    # The text travels once: as one of the kept columns, or else behind them.
    at = kept.index(text_col) if text_col in kept else n
    flag = n if text_col in kept else n + 1

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        table = np.zeros((FEATURES, len(m.labels)))
        table[:] = m.weights
        for batch in batches:
            letters = batch.column(flag).to_pylist()
            langs, scores = [], []
            for a, rows in kernel.text_blocks(batch.column(at)):
                for has, (found, counts) in zip(letters[a : a + len(rows)], feature_counts(rows), strict=True):
                    if not has:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    z = _vector(found, counts, m.idf) @ table[found] + m.bias
                    p = _softmax(z / m.temperature)
                    best = int(np.argmax(p))
                    langs.append(m.labels[best])
                    scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*[f"c{i}" for i in range(n)], "lang_pred", "score"],
            )

    # Positions, not names, tell the columns apart inside the task.
    source = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)],
        *[F.col(f"`{text_col}`").alias("body")] * (at == n),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    schema = source.schema
    made = schema[:n].add("lang_pred", "string").add("score", "double")
    out = source.mapInArrow(apply, made)
    return out.toDF(*kept, "lang_pred", "score")


def held_out(id_col: str = "doc_id") -> Column:
    """Every fifth row by the checksum of its id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
