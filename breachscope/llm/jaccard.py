"""Jaccard join on word shingles through extended prefixes and token combinations.

Every pair of documents whose shingle sets reach the threshold is connected, exactly:

1. One pass makes a row per document: set size, a digest of the set, a parity sketch,
   and counts of all shingles in hashed buckets. Equal sets are one class from here.
2. The number of shingles in a bucket gives each shingle a level of frequency. Rare
   ones come first in the global order, so a prefix holds them as far as there are any,
   and shingles of a shared passage enter it only where a document has little else.
3. A set of ``n`` shingles that must share ``t`` with a partner can miss ``n - t`` of
   its own. A rare shingle of the prefix is indexed alone; frequent ones are dealt into
   groups by hash, and of each group the pairs are indexed. The prefix is extended
   until the single shingles, and in each group all but one, number ``n - t + 1``:
   then any partner shares a single shingle or a whole pair. Sets too small for that
   index single shingles only; sizes about the border do both.
4. In every list of the index each set is compared with the list's smallest one only, then
   with another where that leaves several components. Few are left; then sets of different components that share a list
   are compared, once for all lists that they share, and nothing else needs to be. So a
   group of thousands of near copies costs its size, not its square, and no link between
   components is lost.
5. Size and sketch bounds drop hopeless pairs before any set is fetched; what is left
   is verified on the whole sets, made anew from the texts of the documents concerned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachscope.llm import kernel
from breachscope.llm.components import components
from breachscope.session import release, settle

SHINGLE_WORDS = 5
NUMERATOR, DENOMINATOR = 4, 5  # similarity of 0.8

_GROUPS = 32  # groups of frequent shingles
_SMALL = 2 * _GROUPS  # smaller sets index single shingles only
_BUCKET_BITS = 22
_FREQUENT = 64  # a shingle is frequent in a bucket of so many more than the mean
_LEAST_SKETCH, _LARGEST_SKETCH = 512, 1 << 16  # bits
# Documents whose sets are to be compared are broadcast up to this many (24 bytes each).
BROADCAST_DOCUMENTS = 1_000_000
# Further sets of a list that all others of it are compared with. Each takes a round of jobs.
_MORE_STARS = 1
# A set that is in more open lists than this does not carry them.
_LISTS_CARRIED = 256
_PART_BITS = 14  # buckets travel in rows of 2**14 counts
_FREQUENT_LEVEL = 100  # levels from here on are frequent


@dataclass(frozen=True)
class Rule:
    """Two sets link when ``denominator * shared >= numerator * united``."""

    words: int = SHINGLE_WORDS
    numerator: int = NUMERATOR
    denominator: int = DENOMINATOR

    def __post_init__(self) -> None:
        # Below, a set of _SMALL shingles could fail to fill its extended prefix.
        if not 0.6 * self.denominator <= self.numerator <= self.denominator:
            raise ValueError("the similarity must lie between 0.6 and 1")

    def required(self, n: np.ndarray | int) -> np.ndarray | int:
        """Shingles that a set of ``n`` must share with any partner: a union is no
        smaller than ``n``."""
        return -(-self.numerator * n // self.denominator)

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return self.denominator * shared >= self.numerator * (len(a) + len(b) - shared)


def shingle_sets(rows: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    hashes, bounds = kernel.Words(rows).shingles(words)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        part = np.sort(hashes[a:b])
        if len(part) > 1:
            part = part[np.concatenate(([True], part[1:] != part[:-1]))]
        yield part


def _set_id(shingles: np.ndarray) -> int:
    raw = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def _sketch(shingles: np.ndarray) -> bytes:
    """For each of some bits, about two a shingle, whether an odd number fell on it."""
    bits = _LEAST_SKETCH
    while bits < 2 * len(shingles) and bits < _LARGEST_SKETCH:
        bits *= 2
    place = (shingles >> np.uint64(20)) & np.uint64(bits - 1)
    odd = np.bincount(place.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _sketch_distance(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded to the shorter."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum())


def _folded(sketch: bytes, size: int = _LEAST_SKETCH // 8) -> np.ndarray:
    """A sketch of fewer bytes: odd numbers of odd numbers are odd."""
    x = np.frombuffer(sketch, np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _body() -> Column:
    """Names the text of a row: ids may be null or repeated."""
    return F.xxhash64("text").alias("body")


def _profile(docs: DataFrame, rule: Rule) -> DataFrame:
    """Rows ``(doc_id, body, n, sid, sketch)``, and rows of bucket counts ``(part, counts)``."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = np.zeros(1 << _BUCKET_BITS, np.uint32)
        for batch in batches:
            rows = kernel.byte_rows(batch.column(1))
            for a, b in kernel.blocks(rows):
                sets = list(shingle_sets(rows[a:b], rule.words))
                joined = np.concatenate(sets)
                buckets += np.bincount(
                    (joined >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64), minlength=len(buckets)
                ).astype(np.uint32)
                size = b - a
                sketches = [_sketch(s) for s in sets]
                yield _profile_batch(
                    doc_id=batch.column(0).slice(a, size),
                    body=batch.column(2).slice(a, size),
                    n=pa.array([len(s) for s in sets], pa.int32()),
                    sid=pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64()),
                    sketch=pa.array(sketches, pa.binary()),
                    small=pa.array([_folded(x).view(np.int64).tolist() for x in sketches], pa.list_(pa.int64())),
                )
        parts = buckets.astype("<u4").reshape(-1, 1 << _PART_BITS)
        used = np.flatnonzero(parts.any(axis=1))
        if len(used):
            # One byte a bucket where that is enough.
            raw = [parts[i].astype("<u1" if parts[i].max() < 256 else "<u4").tobytes() for i in used]
            yield _profile_batch(
                part=pa.array(used, pa.int32()), counts=pa.array(raw, pa.binary())
            )

    return docs.select("doc_id", "text", _body()).mapInArrow(
        profile, "doc_id long, body long, n int, sid long, sketch binary, small array<long>, part int, counts binary"
    )


_PROFILE = pa.schema(
    [
        ("doc_id", pa.int64()), ("body", pa.int64()), ("n", pa.int32()), ("sid", pa.int64()),
        ("sketch", pa.binary()), ("small", pa.list_(pa.int64())), ("part", pa.int32()), ("counts", pa.binary()),
    ]
)


def _profile_batch(**columns: pa.Array) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [columns.get(f.name, pa.nulls(rows, f.type)) for f in _PROFILE], schema=_PROFILE
    )


def _bucket_levels(profile: DataFrame) -> np.ndarray:
    """A map of fixed size: how frequent the shingles of each bucket are.

    Levels grow with the logarithm of what a bucket holds beyond the mean, measured in
    standard deviations of the mean; from ``_FREQUENT_LEVEL`` on they are frequent."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}  # 256 parts at most
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(raw, "<u4" if len(raw) == 4 << _PART_BITS else "<u1")
                if part in totals:
                    totals[part] += counts
                else:
                    totals[part] = counts.astype(np.int64)
        if totals:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(totals), pa.int32()),
                    pa.array([t.tobytes() for t in totals.values()], pa.binary()),
                    pa.array([int(t.sum()) for t in totals.values()], pa.int64()),
                ],
                names=["part", "counts", "total"],
            )

    summed = settle(
        profile.where("part IS NOT NULL")
        .select("part", "counts")
        .repartition("part")
        .mapInArrow(add, "part int, counts binary, total long")
    )
    mean = (summed.agg(F.sum("total")).first()[0] or 0) / (1 << _BUCKET_BITS)
    deviation = mean**0.5
    bound = mean + 6 * deviation + _FREQUENT

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for counts in batch.column(1).to_pylist():
                count = np.frombuffer(counts, np.int64)
                level = np.log2(1 + np.maximum(count - mean, 0) / (1 + deviation)).astype(np.uint8)
                raw.append((level + _FREQUENT_LEVEL * (count > bound)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["part", "levels"])

    levels = np.zeros((1 << (_BUCKET_BITS - _PART_BITS), 1 << _PART_BITS), np.uint8)
    # 256 rows of 16 KB, whatever the size of the data.
    for r in summed.select("part", "counts").mapInArrow(mark, "part int, levels binary").collect():
        levels[r["part"]] = np.frombuffer(r["levels"], np.uint8)
    return levels.reshape(-1)


def signatures(shingles: np.ndarray, levels: np.ndarray, rule: Rule) -> np.ndarray:
    """The index keys of a set; see the text of the module."""
    n = len(shingles)
    if not n:
        return shingles
    level = levels[(shingles >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)]
    # By level, and inside a level by hash: one order for all sets.
    ordered = shingles[np.argsort(level, kind="stable")]
    rare = int((level < _FREQUENT_LEVEL).sum())
    need = n - int(rule.required(n)) + 1
    keys = []
    if n * rule.numerator < _SMALL * rule.denominator or need <= rare:
        keys.append(ordered[:need])
    if n >= _SMALL and need > rare:
        late = ordered[rare:]
        group = (kernel.mix(late) % np.uint64(_GROUPS)).astype(np.int64)
        # The first of each group adds nothing, every later one adds one.
        by_group = np.argsort(group, kind="stable")
        g = group[by_group]
        start = np.concatenate(([True], g[1:] != g[:-1]))
        rank = np.empty(len(late), np.int64)
        rank[by_group] = np.arange(len(g)) - np.repeat(np.flatnonzero(start), np.diff(np.append(np.flatnonzero(start), len(g))))
        enough = int(np.searchsorted(np.cumsum(rank > 0), need - rare)) + 1
        late, group, rank = late[:enough], group[:enough], rank[:enough]
        keys.append(ordered[:rare])
        by_group = np.argsort(group, kind="stable")
        members, place = late[by_group], rank[by_group]
        second = np.repeat(np.arange(len(members)), place)
        first = second - kernel.ranges(np.ones(len(members), np.int64), place)
        keys.append(kernel.mix(members[first] * np.uint64(0x9FB21C651E98DF25) ^ members[second]))
    return np.concatenate(keys)


def _index(docs: DataFrame, levels: np.ndarray, rule: Rule) -> DataFrame:
    """Rows ``(sig, sid)``. A set that occurs again in the same task is left out."""
    shared = docs.sparkSession.sparkContext.broadcast(levels.tobytes())

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(shared.value, np.uint8)
        seen: set[int] = set()  # no more than the rows of one task
        for batch in batches:
            rows = kernel.byte_rows(batch.column(0))
            for a, b in kernel.blocks(rows):
                sids, keys = [], []
                for s in shingle_sets(rows[a:b], rule.words):
                    sid = _set_id(s)
                    if len(s) and sid not in seen:
                        seen.add(sid)
                        sids.append(sid)
                        keys.append(signatures(s, levels, rule))
                if not keys:
                    continue
                counts = [len(k) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kernel.signed(np.concatenate(keys))),
                        pa.array(np.repeat(np.array(sids, np.int64), counts)),
                    ],
                    names=["sig", "sid"],
                )

    return docs.select("text").mapInArrow(index, "sig long, sid long")


def _hopeful(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs ``(a, b)`` that sizes and sketches do not rule out.

    The odd bits of two sketches differ in no more places than the sets differ in
    shingles, and linked sets differ in at most
    ``(|a| + |b|) * (d - n) / (d + n)`` of them.
    """
    left = sets.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = sets.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    n, d = rule.numerator, rule.denominator
    sized = (
        pairs.join(left, "a")
        .join(right, "b")
        .where(F.least("n_a", "n_b") * d >= F.greatest("n_a", "n_b") * n)
        .select("a", "b", "s_a", "s_b", ((F.col("n_a") + F.col("n_b")) * (d - n)).alias("bound"))
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (2, 3, 4)]
            good = [
                i
                for i, (x, y, bound) in enumerate(zip(*columns, strict=True))
                if _sketch_distance(x, y) * (d + n) <= bound
            ]
            yield batch.take(pa.array(good, pa.int64())).select(["a", "b"])

    return sized.mapInArrow(test, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that link. Each set is made from a text that has it, the first of a
    pair is sent to where the second is, a bounded number at a time."""
    ends = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    wanted = settle(sets.select("sid", "body").join(ends, "sid"))
    if wanted.count() <= BROADCAST_DOCUMENTS:
        wanted = F.broadcast(wanted)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies of a text: one of a task is enough
        for batch in batches:
            rows, wanted_ids = kernel.byte_rows(batch.column(1)), batch.column(0).to_pylist()
            for a, b in kernel.blocks(rows):
                sids, raw = [], []
                for sid, s in zip(wanted_ids[a:b], shingle_sets(rows[a:b], rule.words), strict=True):
                    if sid not in seen and _set_id(s) == sid:  # else another text of the same hash
                        seen.add(sid)
                        sids.append(sid)
                        raw.append(s.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sids, pa.int64()), pa.array(raw, pa.binary())],
                    names=["sid", "shingles"],
                )

    texts = docs.select("text", _body()).join(wanted, "body").select("sid", "text")
    made = settle(texts.mapInArrow(make, "sid long, shingles binary").dropDuplicates(["sid"]))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = [
                i
                for i, (x, y) in enumerate(zip(left, right, strict=True))
                if rule.links(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
            ]
            yield batch.take(pa.array(good, pa.int64())).select(["a", "b"])

    both = (
        pairs.join(made.select(F.col("sid").alias("a"), F.col("shingles").alias("left")), "a")
        .join(made.select(F.col("sid").alias("b"), F.col("shingles").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    return both.mapInArrow(test, "a long, b long")


def _named(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``sig, sid, component``; a set without a link is a component of its own."""
    components_of = known.select(F.col("node").alias("sid"), "component")
    named = rows.select("sig", "sid").join(components_of, "sid", "left")
    return settle(named.withColumn("component", F.coalesce("component", "sid")))


def _open_lists(named: DataFrame) -> DataFrame:
    """The rows of lists that hold more than one component; ``named`` is removed.

    The shingles of one passage have one list each, but all the same: one is enough.
    Lists are told apart by size and two order-free hashes of their sets."""
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "sid")).alias(f"mark_{i}") for i in range(2)]
    still_open = (
        named.groupBy("sig")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count(F.lit(1)).alias("size"),
            *marks,
        )
        .where("low < high")
        .groupBy("size", "mark_0", "mark_1")
        .agg(F.min("sig").alias("sig"))
        .select("sig")
    )
    held = settle(named.join(still_open, "sig"))
    release(named)
    return held


def jaccard_components(
    docs: DataFrame,
    rule: Rule = Rule(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per input row.

    ``component_id`` is the smallest id that links reach, the row's own included.
    Null, empty and wordless texts have no shingles and link with nothing; a text with
    fewer words than a shingle has its whole word sequence as its one shingle. Rows
    with equal texts link, rows that repeat an id are one document for the component.
    Rows without an id link like others; a component of such rows only has no id. An
    empty input gives an empty result; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    profile = settle(_profile(docs, rule))
    rows = profile.where("part IS NULL")
    levels = _bucket_levels(profile)
    sets = settle(
        rows.where("sid IS NOT NULL")
        .groupBy("sid")
        .agg(F.min("doc_id").alias("doc_id"), F.min("body").alias("body"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("small").alias("small"))
    )

    index = _index(docs, levels, rule)
    # One shuffle by key; keys with a single set go, and most keys are such.
    listed = settle(
        index.withColumn("low", F.expr("min(sid) OVER (PARTITION BY sig)"))
        .withColumn("high", F.expr("max(sid) OVER (PARTITION BY sig)"))
        .where("low < high")
    )
    stars = listed.where("sid > low").select(F.col("low").alias("a"), F.col("sid").alias("b")).distinct()
    hopeful = settle(_hopeful(stars, sets, rule))
    first = settle(_verified(hopeful, sets, docs, rule))
    known = settle(components(first))

    # Lists that still hold more than one component: another set of each, chosen by a
    # hash, is compared with the rest, until few components are left in them.
    held = _open_lists(_named(listed.select("sig", "sid").distinct(), known))
    release(listed, known)
    links, tested = first, hopeful
    for turn in range(_MORE_STARS):
        if held.isEmpty():
            break
        chosen = F.min_by(F.struct("sid", "component"), F.xxhash64(F.lit(turn), "sid"))
        centre = held.groupBy("sig").agg(chosen.alias("centre"))
        stars = (
            held.join(centre, "sig")
            .where(F.col("component") != F.col("centre.component"))
            .select(F.least("sid", "centre.sid").alias("a"), F.greatest("sid", "centre.sid").alias("b"))
            .distinct()
            .join(tested, ["a", "b"], "left_anti")
        )
        hopeful = settle(_hopeful(stars, sets, rule))
        found = settle(_verified(hopeful, sets, docs, rule))
        links, tested, old = settle(links.union(found)), settle(tested.union(hopeful)), (links, tested, held)
        known = settle(components(links))
        held = _open_lists(_named(held, known))
        release(*old, hopeful, found, known)
    # A near copy shares many lists. A pair is looked at in the first one only: each row
    # has the lists before it that its set is in, as long as these are few.
    lists = held.groupBy("sid").agg(F.sort_array(F.collect_set("sig")).alias("lists"))
    before = F.slice("lists", F.lit(1), F.array_position("lists", F.col("sig")).cast("int") - 1)
    earlier = F.when(F.size("lists") <= _LISTS_CARRIED, before)
    left = settle(
        held.join(lists, "sid")
        .withColumn("earlier", earlier)
        .drop("lists")
        .join(sets.select("sid", "n", "small"), "sid")
    )
    ends = [
        left.select("sig", *[F.col(c).alias(f"{c}_{x}") for c in ("sid", "component", "n", "small", "earlier")])
        for x in "ab"
    ]
    seen_before = F.coalesce(F.arrays_overlap("earlier_a", "earlier_b"), F.lit(False))
    # Bounds on sizes and on the small sketches are part of the join: hopeless pairs of
    # a list are never rows.
    differ = sum(
        (F.bit_count(F.col("small_a")[i].bitwiseXOR(F.col("small_b")[i])) for i in range(_LEAST_SKETCH // 64)),
        F.lit(0),
    )
    low, high = rule.numerator, rule.denominator
    across = (
        ends[0]
        .join(ends[1], "sig")
        .where(
            (F.col("component_a") < F.col("component_b"))
            & (F.least("n_a", "n_b") * high >= F.greatest("n_a", "n_b") * low)
            & (differ * (high + low) <= (F.col("n_a") + F.col("n_b")) * (high - low))
            & ~seen_before
        )
        .select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    more = settle(_hopeful(across.join(tested, ["a", "b"], "left_anti"), sets, rule))
    release(held, left)
    last = settle(_verified(more, sets, docs, rule))
    final = settle(components(links.union(last)))
    release(tested, more, links, last)

    # Components are named by set; a document's is the smallest id of its sets.
    of_set = sets.join(final.select(F.col("node").alias("sid"), "component"), "sid", "left").select(
        "sid", "doc_id", F.coalesce("component", "sid").alias("component")
    )
    of_set = settle(of_set)
    named_by = of_set.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = settle(of_set.join(settle(named_by), "component").select("sid", "component_id"))
    return (
        rows.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "sid")
        .join(of_set, "sid", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )
