"""Hard negatives for contrastive training, by cover trees over norm-augmented vectors.

A coordinate added to every candidate gives all the same length, so the angle between
two candidates bounds how far their inner products with an anchor can differ: a node
of covering angle r, at the angle t from the anchor, holds scores between the cosines of
t + r and t - r (times both lengths) and no others.

The top of the tree is a few nodes, fitted on a bounded sample; every candidate goes
to the nearest one. What a top node holds is cut into chunks of bounded size, and each
chunk is a cover tree of its own, built once and stored as one row. Anchors visit
the chunks of their own top node first. That gives a lowest score still of interest,
and with it they visit the other top nodes that can hold a better one. Inside a
chunk the descent goes level by level, leaves out nodes outside the wanted window of
scores, and takes leaves best bound first; their rows are scored exactly, in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breachscope.llm.whitening import usable
from breachscope.session import settle

SCALE = 256
TOP_NODES = 16
SAMPLE_ROWS = 4096  # fits the top nodes
CHUNK_ROWS = 4096
BLOCK_ANCHORS = 4096
LEAF_ROWS = 32  # on average
SHRINK = 1.3  # of the covering angle from level to level

_NO_LIMIT = 1 << 62
_SLACK = 1e-6  # of the product of both lengths, for rounding in angles


@dataclass(frozen=True)
class Rule:
    """The first ``positives`` rows of an anchor's label; for each of them the first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` hundredths of its."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


def _augmented(x: np.ndarray, length: float) -> np.ndarray:
    """Rows of the same length, as unit vectors."""
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(length**2 - (x * x).sum(axis=1), 0))
    return np.column_stack((x, rest)) / length


def farthest_first(unit: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in an order in which each is the farthest from all before it; the angle at
    which it was, and the cosines of all rows with each of them."""
    chosen, angles = [0], [np.pi]
    cosines = np.empty((len(unit), min(most, len(unit))), order="F")
    cosines[:, 0] = unit @ unit[0]
    nearest = cosines[:, 0].copy()
    while len(chosen) < cosines.shape[1]:
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-12:
            break
        angles.append(float(np.arccos(np.clip(nearest[far], -1, 1))))
        cosines[:, len(chosen)] = unit @ unit[far]
        nearest = np.maximum(nearest, cosines[:, len(chosen)])
        chosen.append(far)
    return np.array(chosen), np.array(angles), cosines[:, : len(chosen)]


@dataclass
class Tree:
    """A chunk: rows in the order of their ids, and levels of nodes. The nodes of a level
    are the first rows of ``centres``; each level repeats those of the one above."""

    points: np.ndarray
    labels: np.ndarray
    places: np.ndarray
    centres: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]  # parent and covering angle of each node
    order: np.ndarray  # rows by leaf, then by id
    first: np.ndarray  # where each leaf starts in ``order``
    length: float

    @staticmethod
    def built(points: np.ndarray, labels: np.ndarray, places: np.ndarray, length: float) -> Tree:
        unit = _augmented(points, length)
        centres, angles, cosines = farthest_first(unit, -(-len(points) // LEAF_ROWS))
        sizes, reach = [1], angles[1] if len(angles) > 1 else 0.0
        while sizes[-1] < len(centres):
            reach /= SHRINK
            size = int((angles >= reach).sum())
            if size > sizes[-1]:
                sizes.append(size)
        leaf = cosines.argmax(axis=1)
        levels: list[tuple[np.ndarray, np.ndarray]] = []
        below = leaf
        for above, size in zip([*sizes[-2::-1], 0], sizes[::-1], strict=True):
            away = np.arccos(np.clip(cosines[np.arange(len(points)), below], -1, 1))
            radius = np.zeros(size)
            np.maximum.at(radius, below, away)
            parent = cosines[centres[:size], :above].argmax(axis=1) if above else np.zeros(size, np.int64)
            levels.append((parent, radius))
            below = parent[below]
        order = np.argsort(leaf, kind="stable")
        first = np.searchsorted(leaf[order], np.arange(len(centres) + 1))
        return Tree(points, labels, places, centres, levels[::-1], order, first, length)

    def pack(self) -> dict[str, bytes]:
        parts = {
            "points": self.points, "labels": self.labels, "places": self.places, "centres": self.centres,
            "sizes": np.array([len(p) for p, _ in self.levels]), "order": self.order, "first": self.first,
            "parents": np.concatenate([p for p, _ in self.levels]),
        }
        packed = {name: np.ascontiguousarray(a, np.int64).tobytes() for name, a in parts.items()}
        return packed | {"angles": np.concatenate([r for _, r in self.levels]).tobytes()}

    @staticmethod
    def unpacked(row: dict[str, bytes], length: float) -> Tree:
        at = {name: np.frombuffer(row[name], np.float64 if name == "angles" else np.int64) for name in _PARTS}
        cuts = np.cumsum(at["sizes"])[:-1]
        levels = list(zip(np.split(at["parents"], cuts), np.split(at["angles"], cuts), strict=True))
        points = at["points"].reshape(len(at["labels"]), -1)
        return Tree(points, at["labels"], at["places"], at["centres"], levels, at["order"], at["first"], length)


_PARTS = ("points", "labels", "places", "centres", "sizes", "order", "first", "parents", "angles")


def bounds(theta: np.ndarray, radius: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greatest and least score inside nodes at the angles ``theta`` from the anchors."""
    scale = scale[:, None]
    up = scale * (np.cos(np.maximum(theta - radius, 0)) + _SLACK)
    down = scale * (np.cos(np.minimum(theta + radius, np.pi)) - _SLACK)
    return up, down


def angles_to(anchors: np.ndarray, centres: np.ndarray, length: float) -> tuple[np.ndarray, np.ndarray]:
    """Angles between anchors and centres of the given length; lengths' products."""
    scale = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1)) * length
    dots = anchors.astype(np.float64) @ centres.astype(np.float64).T
    return np.arccos(np.clip(dots / np.maximum(scale, 1e-300)[:, None], -1, 1)), scale


def _scores(a: np.ndarray, b: np.ndarray, exact_in_double: bool) -> np.ndarray:
    if exact_in_double:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _first_k(row: np.ndarray, window: np.ndarray, score: np.ndarray, point: np.ndarray, k: int) -> np.ndarray:
    """Which hits are among the first ``k`` of their anchor and window, in that order."""
    by = np.lexsort((point, -score, window, row))
    new = np.flatnonzero(np.diff(row[by], prepend=-1) | np.diff(window[by], prepend=-1))
    within = np.arange(len(by)) - np.repeat(new, np.diff(np.append(new, len(by))))
    return by[within < k]


def descend(
    tree: Tree, anchors: np.ndarray, labels: np.ndarray, places: np.ndarray,
    low: np.ndarray, high: np.ndarray, k: int, same: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` rows in each window of each anchor: anchor, window, score, row.

    ``low`` and ``high`` have a row for each anchor and a column for each window. Only
    rows with the anchor's label count if ``same``, else only the others; never its own row.
    """
    theta, scale = angles_to(anchors, tree.points[tree.centres], tree.length)
    most = float(scale.max(initial=0))
    if most * 2 * max(len(tree.points), 1) >= _NO_LIMIT:
        raise OverflowError("inner products do not fit 64 bits")
    exact = most < 1 << 52
    low, top = low.copy(), high.max(axis=1)
    alive = np.ones((len(anchors), 1), bool)
    for parent, radius in tree.levels:
        up, down = bounds(theta[:, : len(radius)], radius, scale)
        alive = alive[:, parent] & (up >= low.min(axis=1)[:, None]) & (down <= top[:, None])
    # Best first; where the window ends below a bound, the nearest centre first.
    middle = scale[:, None] * np.cos(theta)
    value = np.where(up > top[:, None], top[:, None] - 1e-3 * np.abs(middle - top[:, None]), up)
    turn = np.argsort(np.argsort(np.where(alive, -value, np.inf), axis=1), axis=1)
    found = tuple(np.zeros(0, np.int64) for _ in range(4))
    done, step = 0, 4
    while done < theta.shape[1]:
        alive &= up >= low.min(axis=1)[:, None]
        now = alive & (turn >= done) & (turn < done + step)
        hits = [found]
        for leaf in np.flatnonzero(now.any(axis=0)):
            rows = np.flatnonzero(now[:, leaf])
            points = tree.order[tree.first[leaf] : tree.first[leaf + 1]]
            score = _scores(anchors[rows], tree.points[points], exact)
            allowed = (labels[rows][:, None] == tree.labels[points]) == same
            allowed &= places[rows][:, None] != tree.places[points]
            for w in range(low.shape[1]):
                ok = allowed & (score >= low[rows, w][:, None]) & (score <= high[rows, w][:, None])
                if len(points) > k and np.count_nonzero(ok) > k * len(rows):
                    key = score * len(points) + np.arange(len(points) - 1, -1, -1)
                    key[~ok] = -_NO_LIMIT
                    ok &= key >= np.partition(key, len(points) - k, axis=1)[:, len(points) - k, None]
                i, j = np.nonzero(ok)
                if len(i):
                    hits.append((rows[i], np.full(len(i), w), score[i, j], points[j]))
        if len(hits) > 1:
            row, window, score, point = (np.concatenate(c) for c in zip(*hits, strict=True))
            kept = _first_k(row, window, score, point, k)
            found = tuple(c[kept] for c in (row, window, score, point))
            # The k-th score of a full window is the least that still matters.
            full = np.flatnonzero(np.arange(len(kept)) >= k - 1)
            full = full[(found[0][full] == found[0][full - k + 1]) & (found[1][full] == found[1][full - k + 1])]
            low[found[0][full], found[1][full]] = found[2][full]
        done, step = done + step, step * 2
    return found


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(column: pa.Array) -> np.ndarray:
    return _vectors(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)


@dataclass(frozen=True)
class _Index:
    """Stored trees, and the top of all of them."""

    trees: DataFrame
    centres: np.ndarray
    radius: np.ndarray
    first_chunk: np.ndarray  # of each top node; one more at the end
    length: float


def _index(candidates: DataFrame, chunk_rows: int) -> _Index | None:
    """Every candidate in a chunk below the nearest of the top nodes."""
    square = F.aggregate("q", F.lit(0).cast("bigint"), lambda s, x: s + x * x)
    longest = candidates.agg(F.max(square)).first()[0]
    if longest is None:
        return None
    length = max(float(np.sqrt(float(longest))) * (1 + 1e-12), 1.0)
    by_hash = candidates.select("q", F.xxhash64("q", "place").alias("h")).orderBy("h").limit(SAMPLE_ROWS)
    sample = np.array([r["q"] for r in by_hash.collect()], np.int64)
    chosen, _, _ = farthest_first(_augmented(sample, length), TOP_NODES)
    centres = sample[chosen]
    top = _augmented(centres, length)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cosines = _augmented(_vectors(batch.column(3)), length) @ top.T
                node = cosines.argmax(axis=1)
                away = np.arccos(np.clip(cosines[np.arange(len(node)), node], -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(node.astype(np.int32)), pa.array(away)],
                    names=["vec_id", "label", "place", "q", "node", "away"],
                )

    fields = "vec_id long, label long, place long, q array<long>, node int, away double"
    assigned = settle(candidates.select("vec_id", "label", "place", "q").mapInArrow(assign, fields))
    held = assigned.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect()
    radius, chunks = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for r in held:
        radius[r["node"]], chunks[r["node"]] = r["r"], -(-r["n"] // chunk_rows)
    first = np.concatenate(([0], np.cumsum(chunks)))

    def of_node(values: np.ndarray) -> Column:
        return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("node") + 1)

    salt = F.pmod(F.xxhash64("place"), of_node(np.maximum(chunks, 1)))
    chunk = (of_node(first[:-1]) + salt).cast("int")

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending"), ("place", "ascending")])  # null ids last
        numbers = (table.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in (1, 2))
        tree = Tree.built(_lists(table.column(3)), *numbers, length)
        packed = tree.pack()
        return pa.table(
            {"chunk": table.column(4).slice(0, 1), "ids": pa.array([table.column(0).to_pylist()], pa.list_(pa.int64()))}
            | {name: pa.array([packed[name]], pa.binary()) for name in _PARTS}
        )

    blobs = ", ".join(f"{name} binary" for name in _PARTS)
    grouped = assigned.select("vec_id", "label", "place", "q", chunk.alias("chunk")).groupBy("chunk")
    trees = settle(grouped.applyInArrow(build, f"chunk int, ids array<long>, {blobs}"))
    return _Index(trees, centres, radius, first, length)


def _visit(index: _Index, requests: DataFrame, blocks: int, k: int, same: bool, home: bool) -> DataFrame:
    """Hits of ``requests(place, label, q, low, high)`` in the chunks of their own top
    node, or in those of all other top nodes that can hold any."""
    centres, radius, first, length = index.centres, index.radius, index.first_chunk, index.length

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            anchors, low, high = (_vectors(batch.column(i)) for i in (2, 3, 4))
            theta, scale = angles_to(anchors, centres, length)
            own = np.arange(len(centres)) == theta.argmin(axis=1)[:, None]
            up, down = bounds(theta, radius, scale)
            near = (up >= low.min(axis=1)[:, None]) & (down <= high.max(axis=1)[:, None])
            row, node = np.nonzero(own if home else near & ~own)
            count = first[node + 1] - first[node]
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            chunk = np.repeat(first[node], count) + offset
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(np.repeat(row, count))) for c in batch.columns), pa.array(chunk.astype(np.int32))],
                names=["place", "label", "q", "low", "high", "chunk"],
            )

    fields = "place long, label long, q array<long>, low array<long>, high array<long>, chunk int"
    block = F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int").alias("block")
    routed = requests.select("place", "label", "q", "low", "high").mapInArrow(route, fields).select("*", block)
    trees = index.trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["place", "w", "score", "vec_id", "of"]
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        stored = {name: left.column(name)[0].as_py() for name in (*_PARTS, "ids")}
        tree = Tree.unpacked(stored, length)
        places, labels = (right.column(i).combine_chunks().to_numpy() for i in (0, 1))
        anchors, low, high = (_lists(right.column(i)) for i in (2, 3, 4))
        row, window, score, point = descend(tree, anchors, labels, places, low, high, k, same)
        ids = pa.array(stored["ids"], pa.int64()).take(pa.array(point))
        columns = [places[row], window, score, ids, tree.places[point]]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return (
        trees.groupBy("chunk", "block")
        .cogroup(routed.groupBy("chunk", "block"))
        .applyInArrow(search, "place long, w long, score long, vec_id long, of long")
    )


def _first(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("place", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "of")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(index: _Index, requests: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """The first ``k`` rows for each window of each request, with their rank."""
    at_home = settle(_first(_visit(index, requests, blocks, k, same, home=True), k))
    least = (
        at_home.where(F.col("rank") == k)
        .groupBy(F.col("place").alias("of_place"))
        .agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("least"))
    )
    raised = F.transform(
        "low",
        lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("least", w.cast("bigint")), x)),
    )
    better = requests.join(least, F.col("place") == F.col("of_place"), "left").withColumn("low", raised)
    away = _visit(index, better, blocks, k, same, home=False)
    return settle(_first(at_home.drop("rank").unionByName(away), k))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    rule: Rule = Rule(),
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    chunk_rows: int = CHUNK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of ``floor(256 x)``; higher ones come first, then smaller
    ids, a null id last. Rows with a null label, a null or empty vector, or a null or
    non-finite entry take no part; vectors of different lengths fail the job. Rows that
    share an id are rows of their own: as anchors each gives its results. Of rows with
    equal vector and label only as many are indexed as one window can hold, the first by
    id, and one more for the anchor itself: the others can be in no result. A negative
    score of a positive leaves no window. An empty input gives an empty result.
    """
    vector = F.col(vec_col)
    stored = settle(
        rows.where(usable(vector) & (F.size(vector) > 0) & F.col(label_col).isNotNull()).select(
            F.col(id_col).cast("bigint").alias("vec_id"),
            F.col(label_col).cast("bigint").alias("label"),
            F.monotonically_increasing_id().alias("place"),
            F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)).alias("q"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
    )
    shortest, longest, anchors = stored.agg(F.min(F.size("q")), F.max(F.size("q")), F.count_if("anchor")).first()
    fields = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} to {longest} entries")
    if not anchors:
        return rows.sparkSession.createDataFrame([], fields)
    copies = Window.partitionBy(F.xxhash64("q"), "q", "label").orderBy(F.asc_nulls_last("vec_id"), "place")
    most = max(rule.positives, rule.negatives) + 1
    candidates = stored.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= most)
    index = _index(candidates.drop("copy", "anchor"), chunk_rows)
    blocks = -(-anchors // block_anchors)
    asking = stored.where("anchor").select("vec_id", "label", "place", "q")
    whole = [F.array(F.lit(x).cast("bigint")) for x in (-_NO_LIMIT, _NO_LIMIT)]
    positives = _search(index, asking.select("*", whole[0].alias("low"), whole[1].alias("high")), blocks, rule.positives, True)
    positives = positives.select(
        F.col("place").alias("p_place"), (F.col("rank") - 1).cast("bigint").alias("p_w"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    # Whole numbers n with low * p <= 100 n <= high * p.
    p = F.col("positive_score")
    low = F.expr(f"({rule.low} * positive_score + pmod(-{rule.low} * positive_score, 100)) div 100")
    high = F.expr(f"({rule.high} * positive_score - pmod({rule.high} * positive_score, 100)) div 100")
    windows = positives.groupBy("p_place").agg(
        F.sort_array(F.collect_list(F.struct("p_w", low.alias("low"), high.alias("high")))).alias("windows")
    )
    requests = asking.join(windows, F.col("place") == F.col("p_place")).select(
        "vec_id", "label", "place", "q", F.col("windows.low").alias("low"), F.col("windows.high").alias("high")
    )
    # Anchors with fewer positives get windows that hold nothing, so that all have as many.
    empty = [F.array_repeat(F.lit(x).cast("bigint"), rule.positives) for x in (_NO_LIMIT, -_NO_LIMIT)]
    requests = settle(
        requests.withColumns(
            {n: F.slice(F.concat(n, e), 1, rule.positives) for n, e in zip(("low", "high"), empty, strict=True)}
        )
    )
    negatives = _search(index, requests, blocks, rule.negatives, False)
    return (
        negatives.join(positives, (F.col("place") == F.col("p_place")) & (F.col("w") == F.col("p_w")))
        .join(asking.select(F.col("vec_id").alias("anchor_id"), F.col("place").alias("a_place")), F.col("place") == F.col("a_place"))
        .select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"), p, F.col("score").alias("negative_score"),
        )
    )
