"""Removal of byte strings that documents with smaller ids contain too, by suffix sorting.

Which suffixes can have a partner is settled first, for all of them at once would not
fit through a shuffle. Of every ``length`` bytes one anchor is chosen: the q-gram with
the smallest hash among those inside. Equal strings choose the same anchor, so a string
that occurs twice has an anchor that occurs twice, and the strings around one anchor
form one short context. Equal strings also agree in half of the bytes that they have
beside the anchor, on its left or on its right: a context stays only where another
document has its anchor with one of these sides. Those that stay meet in a bucket by
anchor. Each chunk names its own by a hash, and one chunk of all that have a context
sends its bytes.

A bucket is suffix-sorted in two stages. Suffixes smaller than their successor are
sorted directly. The others follow from them in one scan over the first bytes in
ascending order: each is placed by the rank of its successor, which is known by then.
Neighbours with a common prefix of ``length`` bytes are occurrences of one string, and
the smallest document id among them decides for all of them.

An anchor in many chunks that has other bytes around it in each, that of a short line in
a third of all documents, say, would gather a context from each of them in one bucket. Its strings are dealt one by one
instead, by a hash of their own: equal ones still meet, and no bucket grows with the anchor.

The texts are shuffled once, into chunks by id; anchors, contexts and the final cut are
computed from that one exchange. Anchors and contexts of a chunk leave it once each,
however many of its documents hold them, so a passage that a third of all documents
share costs a row for each chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breachscope.llm import kernel

LENGTH = 50
GRAM = 20
CHUNK_BYTES = 4 << 20
LEAST_BYTES = 256 << 10
# An anchor with so many contexts, each counted once, in so many chunks is split if it
# has more than one of so many contexts of its bucket. Fewer than that are a bounded
# number of rows from each chunk, or a small part of a bucket.
HOT_CHUNKS = 32
HOT_SHARE = 64
# A bucket is sorted in so many parts, one after the other: sorting takes many times the
# bytes that it sorts.
PARTS = 16
_NO_ID = 2**63 - 1
# Marks a context that is a single string of a split anchor.
_SINGLE = 0x8000
_SINGLE_FIRST = 0xFFFF
# What is told of a context of a chunk: that it stays, that this chunk sends its bytes,
# that its strings go one by one.
_FLAGS = (1, 2, 4)
_STAYS, _SENT, _HOT = _FLAGS
_SEEN_BITS = 20


# ---------------------------------------------------------------- suffix sorting


def _be_words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number that sorts like them."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    words = np.zeros(len(text), np.uint64)
    for j in range(8):
        words |= padded[j : j + len(text)].astype(np.uint64) << np.uint64(56 - 8 * j)
    return words


class _Prefixes:
    """The first ``depth`` bytes of any suffix, eight at a time."""

    def __init__(self, text: np.ndarray, depth: int):
        self.words = _be_words(np.concatenate((text, np.zeros(depth + 8, np.uint8))))
        self.steps = -(-depth // 8)
        rest = depth - 8 * (self.steps - 1)
        self._last = np.uint64(64 - 8 * rest)

    def step(self, at: np.ndarray, k: int) -> np.ndarray:
        w = self.words[at + 8 * k]
        return w >> self._last if k == self.steps - 1 else w


def _sort_directly(at: np.ndarray, prefixes: _Prefixes) -> np.ndarray:
    """``at`` in the order of its suffixes; only ties look at further bytes."""
    order = at[np.argsort(prefixes.step(at, 0), kind="stable")]
    value = prefixes.step(order, 0)
    new = np.concatenate(([True], value[1:] != value[:-1])) if len(order) else np.zeros(0, bool)
    for k in range(1, prefixes.steps):
        tied = ~new
        tied[:-1] |= ~new[1:]
        place = np.flatnonzero(tied)
        if not len(place):
            break
        group = np.cumsum(new)[place]
        sub = order[place]
        value = prefixes.step(sub, k)
        inner = np.lexsort((value, group))
        order[place] = sub[inner]
        value, group = value[inner], group[inner]
        differs = np.concatenate(([True], (value[1:] != value[:-1]) | (group[1:] != group[:-1])))
        new[place] |= differs
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` in the order of the ``depth`` bytes from there on.

    Beyond the end the text counts as zeros; suffixes equal in ``depth`` bytes stand
    in any order.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    prefixes = _Prefixes(text, depth)
    following = np.append(text[1:], 0)
    # A run of one byte takes its type from the byte after it.
    ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    length = np.diff(np.concatenate(([-1], ends)))
    direct = np.repeat(following[ends] > text[ends], length)

    counts = np.bincount(text, minlength=256)
    base = np.concatenate(([0], np.cumsum(counts)))[:-1]
    induced = np.flatnonzero(~direct)
    induced_counts = np.bincount(text[induced], minlength=256)
    array = np.empty(n, np.int64)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # the end sorts first

    ordered = _sort_directly(np.flatnonzero(direct), prefixes)
    bytes_of = text[ordered]
    first = np.searchsorted(bytes_of, np.arange(256))
    place = np.arange(len(ordered)) - first[bytes_of] + (base + induced_counts)[bytes_of]
    array[place] = ordered
    rank[ordered] = place

    # Induced suffixes whose successor starts with a smaller byte, by first byte.
    is_end = np.zeros(n, bool)
    is_end[ends] = True
    heads = induced[is_end[induced]]
    heads = heads[np.argsort(text[heads], kind="stable")]
    bounds = np.searchsorted(text[heads], np.arange(257))
    for c in np.flatnonzero(induced_counts).tolist():
        start = int(base[c])
        level = heads[bounds[c] : bounds[c + 1]]
        level = level[np.argsort(rank[level + 1], kind="stable")]
        while len(level):
            stop = start + len(level)
            array[start:stop] = level
            rank[level] = np.arange(start, stop)
            start = stop
            # One byte further left in the same run comes after all shorter runs.
            level = level[level > 0] - 1
            level = level[text[level] == c]
    return array


def smallest_owner(text: np.ndarray, owner: np.ndarray, valid: np.ndarray, depth: int) -> np.ndarray:
    """For each place in ``valid`` order, the least owner of an equal ``depth``-byte string.

    ``owner`` is given for every place; only the ``valid`` ones are compared."""
    array = suffix_array(text, depth)
    array = array[valid[array]]
    prefixes = _Prefixes(text, depth)
    same = np.ones(max(len(array) - 1, 0), bool)
    for k in range(prefixes.steps):
        value = prefixes.step(array, k)
        same &= value[1:] == value[:-1]
    out = np.full(len(text), _NO_ID, np.int64)
    if len(array):
        starts = np.flatnonzero(np.concatenate(([True], ~same)))
        least = np.minimum.reduceat(owner[array], starts)
        out[array] = np.repeat(least, np.diff(np.append(starts, len(array))))
    return out


# ----------------------------------------------------------------------- chunks


class Chunk:
    """Documents of one chunk with their anchors.

    Record ``i`` says: the strings that start at ``first[i] .. last[i]``, all in the
    document ``row[i]``, share the anchor with the hash ``anchor[i]``."""

    def __init__(self, table: pa.Table, length: int, gram: int):
        ids = table.column("doc_id")
        self.ids = np.array(ids.to_pylist(), dtype=object)
        self.order_ids = np.array([_NO_ID if x is None else x for x in self.ids], np.int64)
        self.rows = kernel.byte_rows(table.column("text"))
        self.bytes, self.start = kernel.joined(self.rows, np.arange(256, dtype=np.uint8))
        self.length = length
        self._find_anchors(gram)

    def _find_anchors(self, gram: int) -> None:
        length = self.length
        self.prefix = kernel.Prefix(self.bytes)
        grams = self.prefix.windows(gram)
        width = length - gram + 1
        key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            key = np.minimum(key[: max(len(key) - reach, 0)], key[reach:])
            reach *= 2
        if reach < width:
            key = np.minimum(key[: max(len(key) - (width - reach), 0)], key[width - reach :])
        lengths = np.diff(self.start) - 1
        counts = np.maximum(lengths - length + 1, 0)
        windows = kernel.ranges(self.start[:-1], counts)
        at = (key[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        row = np.repeat(np.arange(len(counts)), counts)
        if len(windows):
            new = np.concatenate(([True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])))
        else:
            new = np.zeros(0, bool)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(windows)) - 1 if len(begin) else begin
        self.first, self.last = windows[begin], windows[end]
        self.row = row[begin]
        self.anchor = grams[at[begin]]
        self._at, self._gram = at[begin], gram
        self._lead = (self._at - self.first).astype(np.uint64)

    def contexts(self) -> np.ndarray:
        """A hash of each record's bytes and of where the anchor lies in them."""
        return kernel.mix(
            self.prefix.spans(self.first, self.last + self.length) + self._lead * np.uint64(0x9FB21C651E98DF25)
        )

    def sides(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A byte each for what is left and right of the anchor. A string has ``left``
        bytes before its anchor or else ``right`` bytes after it. Where no string of the
        record has them, the byte is one of its context."""
        rest = self.length - self._gram
        left = (rest + 1) // 2
        right = rest - left + 1
        end = self._at + self._gram
        out = []
        for begin, stop, has in (
            (self._at - left, self._at, self._at - self.first >= left),
            (end, end + right, self.last + self.length - end >= right),
        ):
            begin, stop = np.where(has, begin, 0), np.where(has, stop, 0)
            hashed = np.where(has, self.prefix.spans(begin, stop), contexts)
            out.append((hashed & np.uint64(0xFF)).astype(np.uint8))
        return out[0], out[1]

    def strings(self, starts: np.ndarray) -> np.ndarray:
        """A hash of the string at each start; another than that of an equal context."""
        found = self.prefix.spans(starts, starts + self.length)
        return kernel.mix(found ^ np.uint64(0x632BE59BD9B4E019))

    def found(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of strings that have one of the ascending hashes, and which one."""
        hashed = kernel.mix(self.prefix.windows(self.length) ^ np.uint64(0x632BE59BD9B4E019))
        # Most strings are told apart by a few bits; only the others are searched.
        high = np.uint64(64 - _SEEN_BITS)
        seen = np.zeros(1 << _SEEN_BITS, bool)
        seen[(known >> high).astype(np.int64)] = True
        starts = np.flatnonzero(seen[(hashed >> high).astype(np.int64)])
        row = np.searchsorted(self.start, starts, "right") - 1
        starts = starts[starts + self.length < self.start[row + 1]]
        at = np.minimum(np.searchsorted(known, hashed[starts]), len(known) - 1)
        same = known[at] == hashed[starts]
        return starts[same], at[same]


class _Kinds:
    """The contexts of a chunk by bucket and anchor, each once, in an order that is the
    same whenever the chunk is read. ``order[start[i]]`` is a record of the ``i``th."""

    def __init__(self, c: Chunk, buckets: int):
        contexts = c.contexts()
        bucket = _bucket(c.anchor, buckets)
        # Of an anchor, the bucket and 40 bits are sent; contexts matter where it occurs again.
        key = bucket.astype(np.uint64) << np.uint64(40) | c.anchor >> np.uint64(24)
        self.order = np.argsort(key, kind="stable")
        key = key[self.order]
        again = np.flatnonzero(key[1:] == key[:-1])
        again = np.union1d(again, again + 1)
        inner = np.lexsort((contexts[self.order[again]], key[again]))
        self.order[again] = self.order[again][inner]
        around = contexts[self.order]
        self.new_anchor = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
        new = self.new_anchor.copy()
        new[1:] |= around[1:] != around[:-1]
        self.start = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        self.contexts = contexts
        self.split = _split(bucket[self.order[self.start]])


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor & np.uint64(0xFFFFFF)) % np.uint64(buckets)).astype(np.int64)


def _part(anchor: np.ndarray) -> np.ndarray:
    """By bits that neither choose the anchor nor its bucket."""
    return ((anchor >> np.uint64(24)) % np.uint64(PARTS)).astype(np.uint8)


def _split(buckets: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) for each run of a sorted array."""
    begin = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1]))) if len(buckets) else []
    end = np.append(begin[1:], len(buckets)) if len(buckets) else []
    return [(int(buckets[a]), int(a), int(b)) for a, b in zip(begin, end, strict=True)]


def _pack40(keys: np.ndarray) -> bytes:
    """The upper 40 bits of 64-bit hashes, five bytes each."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 3:]).tobytes()


def _unpack40(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


_TEXTS = "chunk long, ids array<long>, sizes array<int>, text binary"
_ANCHORS = "bucket int, chunk long, keys binary, around binary, sides binary, several binary"
_REPEATED = "chunk long, bucket int, flags binary"
_CONTEXTS = "bucket int, chunk long, hash binary, least binary, greatest binary, size binary, text binary, part binary"
_OWNERS = "chunk long, hash binary, first binary, count binary, owner binary"
_CUT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
)


_PACKED = ("least", "greatest", "size", "text", "part")
_WIDTH = {"least": 8, "greatest": 8, "size": 2, "part": 1}


def _turned(raw: bytes, rows: int) -> bytes:
    """The bytes of a table of so many rows, column by column."""
    return np.frombuffer(raw, np.uint8).reshape(rows, -1).T.tobytes() if raw else raw


def _packed(contexts: pa.Table) -> pa.Table:
    """The columns but the hashes as they are shuffled: smaller than the shuffle makes
    them. The first bytes of all ids come first, then the second ones, and so on; of the
    greatest id it is what the least one lacks."""
    least = _column(contexts, "least")
    for name in _PACKED:
        made = []
        for i, raw in enumerate(_column(contexts, name)):
            if name == "greatest":
                raw = (np.frombuffer(raw, "<i8") - np.frombuffer(least[i], "<i8")).tobytes()
            plain = raw if name == "text" else _turned(raw, len(raw) // _WIDTH[name])
            made.append(len(raw).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True))
        at = contexts.schema.get_field_index(name)
        contexts = contexts.set_column(at, name, pa.array(made, pa.binary()))
    return contexts


def _unpacked(contexts: pa.Table) -> pa.Table:
    for name in _PACKED:
        made = []
        for raw in _column(contexts, name):
            plain = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
            made.append(plain if name == "text" else _turned(plain, _WIDTH[name]))
        if name == "greatest":
            both = zip(made, _column(contexts, "least"), strict=True)
            made = [(np.frombuffer(x, "<i8") + np.frombuffer(y, "<i8")).tobytes() for x, y in both]
        at = contexts.schema.get_field_index(name)
        contexts = contexts.set_column(at, name, pa.array(made, pa.binary()))
    return contexts


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``chunk, doc_id, text`` as one row for each chunk of a batch, its texts packed."""
    for batch in batches:
        order = pa.array(np.argsort(batch.column(0).to_numpy(), kind="stable"))
        chunk, ids = batch.column(0).take(order).to_numpy(), batch.column(1).take(order)
        # Null counts as empty.
        rows = pc.fill_null(batch.column(2).cast(pa.large_string()), "").take(order)
        ends = np.frombuffer(rows.buffers()[1], np.int64)[: len(rows) + 1] if len(rows) else np.zeros(1, np.int64)
        made = []
        for k, i, j in _split(chunk):
            data = rows.buffers()[2].slice(int(ends[i]), int(ends[j] - ends[i])) if ends[j] > ends[i] else b""
            made.append((k, ids.slice(i, j - i).to_pylist(), np.diff(ends[i : j + 1]), pa.compress(data, codec="zstd", asbytes=True)))
        columns = zip(*made, strict=True) if made else [[]] * 4
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)],
            names=["chunk", "ids", "sizes", "text"],
        )


def _unpacked_texts(table: pa.Table) -> pa.Table:
    """``doc_id, text`` of the packed rows of a chunk."""
    sizes = pc.list_flatten(table.column("sizes")).combine_chunks().to_numpy().astype(np.int64)
    per_row = pc.list_value_length(table.column("sizes")).to_numpy()
    ends = np.concatenate(([0], np.cumsum(sizes)))
    bounds = ends[np.concatenate(([0], np.cumsum(per_row)))]
    data = b"".join(
        pa.decompress(x, int(n), codec="zstd", asbytes=True)
        for x, n in zip(_column(table, "text"), np.diff(bounds).tolist(), strict=True)
    )
    text = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return pa.table({"doc_id": pc.list_flatten(table.column("ids")), "text": text})


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.table(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys of 40 bits as their differences."""
    steps = np.diff(keys >> np.uint64(24), prepend=np.uint64(0)) << np.uint64(24)
    return pa.compress(_turned(_pack40(steps), len(keys)), codec="zstd", asbytes=True)


def _unpacked_keys(raw: bytes, count: int) -> np.ndarray:
    plain = _turned(pa.decompress(raw, 5 * count, codec="zstd", asbytes=True), 5)
    return np.cumsum(_unpack40(plain), dtype=np.uint64)


def _anchors(chunk: int, c: Chunk, buckets: int) -> pa.Table:
    """Each anchor of the chunk with each of its contexts, of which 40 bits of the hash
    and the two sides are sent, and whether several of its documents have the anchor."""
    kinds = _Kinds(c, buckets)
    rows = []
    if len(kinds.start):
        row, start = c.row[kinds.order], np.flatnonzero(kinds.new_anchor)
        several = np.minimum.reduceat(row, start) < np.maximum.reduceat(row, start)
        several = np.repeat(several, np.diff(np.append(start, len(row))))[kinds.start]
        once = kinds.order[kinds.start]
        anchor, around = c.anchor[once], kinds.contexts[once]
        left, right = (x[once] for x in c.sides(kinds.contexts))
        for b, i, j in kinds.split:
            rows.append(
                (
                    b,
                    chunk,
                    _packed_keys(anchor[i:j]),
                    _pack40(around[i:j]),
                    left[i:j].tobytes() + right[i:j].tobytes(),
                    np.packbits(several[i:j]).tobytes(),
                )
            )
    return _table(_ANCHORS, rows)


def _in_two_chunks(groups: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """Whether the group of each entry is in several chunks; entries come by chunk."""
    order = np.argsort(groups, kind="stable")
    g = groups[order]
    start = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    stop = np.append(start[1:], len(g))
    many = chunk[order[start]] != chunk[order[stop - 1]]
    out = np.empty(len(g), bool)
    out[order] = np.repeat(many, stop - start)
    return out


def _repeated(table: pa.Table) -> pa.Table:
    """For each chunk of the bucket, which of its contexts another document may share a
    string with, which of these it has to send, and which anchors are to be split."""
    table = table.sort_by("chunk")  # the same chunk sends a context if this is done again
    bucket = table.column("bucket")[0].as_py()
    chunks = _column(table, "chunk")
    around = [_unpack40(x) for x in _column(table, "around")]
    counts = np.array([len(x) for x in around])
    keys = [_unpacked_keys(x, n) for x, n in zip(_column(table, "keys"), counts.tolist(), strict=True)]
    several = np.concatenate(
        [
            np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)
            for x, n in zip(_column(table, "several"), counts.tolist(), strict=True)
        ]
    )
    sides = [np.frombuffer(x, np.uint8).reshape(2, -1) for x in _column(table, "sides")]
    bounds = np.concatenate(([0], np.cumsum(counts)))
    _, anchor, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    del keys
    place = np.flatnonzero(several | (times[anchor] > 1))
    flags = np.zeros(bounds[-1], np.uint8)
    if len(place):
        anchor = anchor[place]
        chunk = (np.searchsorted(bounds, place, "right") - 1).astype(np.int32)
        sides = np.concatenate(sides, axis=1)[:, place]
        good = several[place].copy()
        for side in sides:
            good |= _in_two_chunks(anchor << 8 | side, chunk)
        place, anchor, chunk = place[good], anchor[good], chunk[good]
        around = np.concatenate(around)[place]
    if len(place):
        order = np.lexsort((around, anchor))  # stable: the first of each is in the least chunk
        a, x = anchor[order], around[order]
        new_anchor = np.concatenate(([True], a[1:] != a[:-1]))
        first = new_anchor | np.concatenate(([True], x[1:] != x[:-1]))
        sent = np.zeros(len(place), bool)
        sent[order[first]] = True
        # An anchor with many contexts in many chunks.
        start = np.flatnonzero(new_anchor)
        kinds = np.add.reduceat(first, start, dtype=np.int64)
        by_chunk = np.argsort(anchor, kind="stable")
        a, at = anchor[by_chunk], chunk[by_chunk]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (at[1:] != at[:-1])))
        chunks_of = np.add.reduceat(new, start, dtype=np.int64)
        hot = np.empty(len(place), bool)
        is_hot = (np.minimum(kinds, chunks_of) >= HOT_CHUNKS) & (kinds * HOT_SHARE >= len(flags))
        hot[order] = np.repeat(is_hot, np.diff(np.append(start, len(place))))
        flags[place] = _STAYS + _SENT * sent + _HOT * hot
    rows = []
    for k, i, j in zip(chunks, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = flags[i:j]
        if own.any():
            rows.append((k, bucket, b"".join(np.packbits(own & f > 0).tobytes() for f in _FLAGS)))
    return _table(_REPEATED, rows)


def _gathered(
    chunk: int, buckets: np.ndarray, parts: np.ndarray, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray,
    c: Chunk, first: np.ndarray, sent: np.ndarray, mark: int,
) -> list[tuple]:
    """Rows of contexts, each once with the least and the greatest id that has it; those
    whose bytes are sent come first."""
    order = np.lexsort((ids, hashes, ~sent, buckets))
    if not len(order):
        return []
    hashes, ids = hashes[order], ids[order]
    start = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    stop = np.append(start[1:], len(hashes)) - 1
    once = order[start]
    with_text = np.concatenate(([0], np.cumsum(sent[once])))
    told = once[sent[once]]
    size, parts = size[told], parts[told]
    ends = np.concatenate(([0], np.cumsum(size)))
    text = c.bytes[kernel.ranges(first[told], size)].tobytes()
    rows = []
    for b, i, j in _split(buckets[once]):
        p, q = int(with_text[i]), int(with_text[j])
        rows.append(
            (
                b,
                chunk,
                hashes[start[i:j]].astype("<u8").tobytes(),
                ids[start[i:j]].astype("<i8").tobytes(),
                ids[stop[i:j]].astype("<i8").tobytes(),
                (size[p:q] | mark).astype("<u2").tobytes(),
                text[int(ends[p]) : int(ends[q])],
                parts[p:q].tobytes(),
            )
        )
    return rows


def _contexts(chunk: int, c: Chunk, repeated: pa.Table, buckets: int) -> pa.Table:
    """Each context of the chunk that stays, once; of split anchors each string."""
    rows = []
    if repeated.num_rows:
        kinds = _Kinds(c, buckets)
        told = np.zeros(len(kinds.start), np.uint8)
        within = {b: (i, j) for b, i, j in kinds.split}
        for b, raw in zip(_column(repeated, "bucket"), _column(repeated, "flags"), strict=True):
            i, j = within[b]
            planes = np.frombuffer(raw, np.uint8).reshape(len(_FLAGS), -1)
            for flag, plane in zip(_FLAGS, planes, strict=True):
                told[i:j] += np.unpackbits(plane, count=j - i) * np.uint8(flag)
        flags = np.zeros(len(kinds.order), np.uint8)
        flags[kinds.order] = told[kinds.of]
        ids = c.order_ids[c.row]
        kept = np.flatnonzero((flags & _STAYS > 0) & (flags & _HOT == 0))
        split = np.flatnonzero(flags & _HOT > 0)
        anchor = c.anchor[kept]
        size = c.last[kept] - c.first[kept] + c.length
        rows = _gathered(
            chunk, _bucket(anchor, buckets), _part(anchor), kinds.contexts[kept], ids[kept], size, c, c.first[kept],
            flags[kept] & _SENT > 0, 0,
        )
        if len(split):
            many = c.last[split] - c.first[split] + 1
            starts = kernel.ranges(c.first[split], many)
            hashes = c.strings(starts)
            size = np.full(len(starts), c.length)
            rows += _gathered(
                chunk, _bucket(hashes, buckets), _part(hashes), hashes, np.repeat(ids[split], many), size, c, starts,
                np.ones(len(starts), bool), _SINGLE,
            )
    return _table(_CONTEXTS, rows)


def _runs(
    text: np.ndarray, owner: np.ndarray, size: np.ndarray, begins: np.ndarray, length: int
) -> tuple[np.ndarray, ...]:
    """The runs of starts in each context whose strings have one owner: context, first
    start, number of starts and owner."""
    starts = np.cumsum(size + 1) - size - 1  # a zero byte ends each context
    joined = np.zeros(int((size + 1).sum()), np.uint8)
    joined[kernel.ranges(starts, size)] = text[kernel.ranges(begins, size)]
    windows = size - length + 1
    valid = np.zeros(len(joined), bool)
    at = kernel.ranges(starts, windows)
    valid[at] = True
    found = smallest_owner(joined, np.repeat(owner, size + 1), valid, length)[at]
    of = np.repeat(np.arange(len(size)), windows)
    new = np.flatnonzero(np.concatenate(([True], (found[1:] != found[:-1]) | (of[1:] != of[:-1]))))
    return of[new], at[new] - starts[of[new]], np.diff(np.append(new, len(found))), found[new]


def _owners(table: pa.Table, length: int) -> pa.Table:
    """Sort the strings of a bucket, part by part; tell each chunk which of its contexts
    hold strings of a smaller document, as runs of starts with one owner."""
    chunks = _column(table, "chunk")
    raw_hashes = [np.frombuffer(x, "<u8") for x in _column(table, "hash")]
    counts = np.array([len(x) for x in raw_hashes])
    from_row = np.repeat(np.arange(len(chunks)), counts)
    hashes = np.concatenate(raw_hashes)
    least = np.concatenate([np.frombuffer(x, "<i8") for x in _column(table, "least")])
    greatest = np.concatenate([np.frombuffer(x, "<i8") for x in _column(table, "greatest")])
    raw_sizes = [np.frombuffer(x, "<u2") for x in _column(table, "size")]
    # The bytes of a context are sent once at least, by the first ones of a row.
    sent = kernel.ranges(np.cumsum(counts) - counts, np.array([len(x) for x in raw_sizes]))
    sizes = np.concatenate(raw_sizes).astype(np.int64)
    part = np.concatenate([np.frombuffer(x, np.uint8) for x in _column(table, "part")])
    single = (sizes & _SINGLE) > 0
    sizes &= _SINGLE - 1
    text = np.frombuffer(b"".join(_column(table, "text")), np.uint8)
    begins = np.cumsum(sizes) - sizes

    # Equal contexts are sorted once, for the least id of all.
    order = np.argsort(hashes, kind="stable")
    new = np.concatenate(([True], hashes[order[1:]] != hashes[order[:-1]]))
    owner = np.minimum.reduceat(least[order], np.flatnonzero(new))
    one = np.empty(len(hashes), np.int64)
    one[order] = np.cumsum(new) - 1
    at = np.full(len(owner), -1, np.int64)
    at[one[sent]] = np.arange(len(sent))
    if (at < 0).any():
        raise ValueError("two contexts of one anchor agree in 40 bits of their hashes")

    found = []
    for p in np.unique(part):
        of = np.flatnonzero(part[at] == p)
        run_of, *run = _runs(text, owner[of], sizes[at[of]], begins[at[of]], length)
        found.append((of[run_of], *run))
    run_of, run_first, run_count, run_owner = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(run_of, kind="stable")
    run_of, run_first, run_count, run_owner = run_of[order], run_first[order], run_count[order], run_owner[order]
    bounds = np.searchsorted(run_of, np.arange(len(owner) + 1))
    per = np.diff(bounds)[one]
    run = kernel.ranges(bounds[one], per)
    item = np.repeat(np.arange(len(one)), per)
    useful = run_owner[run] < greatest[item]
    run, item = run[useful], item[useful]
    first = np.where(single[at][one[item]], _SINGLE_FIRST, run_first[run])
    rows = []
    for i, a, b in _split(from_row[item]):
        rows.append(
            (
                chunks[i],
                hashes[item[a:b]].astype("<u8").tobytes(),
                first[a:b].astype("<u2").tobytes(),
                run_count[run[a:b]].astype("<u2").tobytes(),
                run_owner[run[a:b]].astype("<i8").tobytes(),
            )
        )
    return _table(_OWNERS, rows)


def _cut(c: Chunk, owners: pa.Table, keep_bytes: bool) -> pa.Table:
    """Drop the bytes of strings that a smaller document owns."""
    edges = np.zeros(len(c.bytes) + 1, np.int32)
    if owners.num_rows:
        hashes = np.concatenate([np.frombuffer(x, "<u8") for x in _column(owners, "hash")])
        first = np.concatenate([np.frombuffer(x, "<u2") for x in _column(owners, "first")]).astype(np.int64)
        count = np.concatenate([np.frombuffer(x, "<u2") for x in _column(owners, "count")]).astype(np.int64)
        owner = np.concatenate([np.frombuffer(x, "<i8") for x in _column(owners, "owner")])
        order = np.argsort(hashes, kind="stable")
        hashes, first, count, owner = hashes[order], first[order], count[order], owner[order]
        single = first == _SINGLE_FIRST
        if single.any():
            starts, at = c.found(hashes[single])
            foreign = owner[single][at] < c.order_ids[np.searchsorted(c.start, starts, "right") - 1]
            np.add.at(edges, starts[foreign], 1)
            np.add.at(edges, starts[foreign] + c.length, -1)
            hashes, first, count, owner = (x[~single] for x in (hashes, first, count, owner))
        own = c.contexts()
        low = np.searchsorted(hashes, own, "left")
        many = np.searchsorted(hashes, own, "right") - low
        run = kernel.ranges(low, many)
        record = np.repeat(np.arange(len(own)), many)
        foreign = owner[run] < c.order_ids[c.row[record]]
        run, record = run[foreign], record[foreign]
        begin = c.first[record] + first[run]
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + count[run] - 1 + c.length, -1)
    gone = np.cumsum(edges[:-1]) > 0
    rows = []
    for i, body in enumerate(c.rows):
        a = int(c.start[i])
        mask = gone[a : a + len(body)]
        removed = int(mask.sum())
        spans = 0
        if removed:
            spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
            kept = c.bytes[a : a + len(body)][~mask].tobytes()
        else:
            kept = body
        digest = hashlib.sha256(kept).hexdigest()
        rows.append((c.ids[i], len(body), removed, spans, digest, kept if keep_bytes else None))
    return _table(_CUT, rows)


def without_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_bytes: bool = False,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``, one row per input row.

    Every byte is removed that is covered by a string of ``length`` bytes which also
    starts in a document with a smaller id. Strings never cross documents, may overlap
    themselves, and are judged on the input. Null text is empty. A null id counts as
    larger than any other; documents that share an id do not remove each other's
    strings. ``kept`` holds the remaining bytes if ``keep_bytes``, else null: a cut may
    fall inside a character. An empty input gives an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Enough for all tasks, but no more than the texts fill: each pair of them is a row.
    chunks = max(min(2 * tasks, -(-size // LEAST_BYTES)), -(-size // CHUNK_BYTES), 1)
    # A null or repeated id must not make a chunk: rows are dealt by id and checksum.
    texts = source.select(
        F.pmod(
            F.xxhash64("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))), F.lit(chunks)
        ).alias("chunk"),
        "doc_id",
        "text",
    ).mapInArrow(_packed_texts, _TEXTS)
    buckets = int(min(max(min(2 * tasks, size // LEAST_BYTES), size // (4 * CHUNK_BYTES), 1), 1 << 24))

    def chunk_of(table: pa.Table) -> Chunk:
        return Chunk(_unpacked_texts(table), length, gram)

    def find(key: tuple, table: pa.Table) -> pa.Table:
        return _anchors(key[0].as_py(), chunk_of(table), buckets)

    def gather(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _packed(_contexts(key[0].as_py(), chunk_of(left), right, buckets))

    def decide(table: pa.Table) -> pa.Table:
        return _owners(_unpacked(table), length)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        return _cut(chunk_of(left), right, keep_bytes)

    by_chunk = texts.groupBy("chunk")
    repeated = by_chunk.applyInArrow(find, _ANCHORS).groupBy("bucket").applyInArrow(_repeated, _REPEATED)
    contexts = by_chunk.cogroup(repeated.groupBy("chunk")).applyInArrow(gather, _CONTEXTS)
    owners = contexts.groupBy("bucket").applyInArrow(decide, _OWNERS)
    return by_chunk.cogroup(owners.groupBy("chunk")).applyInArrow(cut, _CUT)
