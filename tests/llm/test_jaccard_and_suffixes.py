import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from breachscope.llm import jaccard, suffixes
from breachscope.llm.components import components
from breachscope.llm.jaccard import Rule, jaccard_components, signatures


def _sets(texts, words):
    out = []
    for i, t in texts:
        w = (t or "").encode().lower().split()
        out.append((i, {tuple(w[k : k + words]) for k in range(max(len(w) - words + 1, 1))} if w else set()))
    return out


def _roots(nodes, edges):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize(
    "rule, frequent", [(Rule(), 64), (Rule(4, 85, 100), -10), (Rule(2, 6, 10), -10), (Rule(2, 6, 10), 64)]
)
def test_components_agree_with_brute_force(docs, texts, rule, frequent, monkeypatch):
    monkeypatch.setattr(jaccard, "_FREQUENT", frequent)  # below zero: every shingle is frequent
    sets = _sets(texts, rule.words)
    edges = [
        (a, b)
        for k, (a, s) in enumerate(sets)
        for b, t in sets[:k]
        if s and t and rule.denominator * len(s & t) >= rule.numerator * len(s | t)
    ]
    root = _roots({i for i, _ in texts}, edges)
    found = sorted(tuple(r) for r in jaccard_components(docs, rule).collect())
    assert found == sorted((i, len(s), root[i]) for i, s in sets)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    rule = Rule(4, 8, 10)
    for trial in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = a.copy()
        for _ in range(rng.integers(0, max(len(a) // 8, 1) + 1)):
            b[rng.integers(0, len(b))] = rng.integers(0, 2**63, dtype=np.uint64)
        b = np.unique(b[: len(b) - int(rng.integers(0, len(b) // 12 + 1))])
        frequent = rng.random(1 << jaccard._BUCKET_BITS) < rng.choice([0.0, 0.5, 0.97, 1.0])
        levels = np.where(frequent, 100, 0).astype(np.uint8) + (rng.random(len(frequent)) < 0.3)
        if rule.links(a, b):
            assert np.intersect1d(signatures(a, levels, rule), signatures(b, levels, rule)).size


def test_sketches_never_overstate_the_difference():
    rng = np.random.default_rng(2)
    for n, m in ((50, 60), (300, 2000), (5000, 90)):
        a, b = (np.unique(rng.integers(0, 2**63, k, dtype=np.uint64)) for k in (n, m))
        b[: min(n, m) // 2] = a[: min(n, m) // 2]
        b = np.unique(b)
        differ = len(np.setxor1d(a, b))
        assert jaccard._sketch_distance(jaccard._sketch(a), jaccard._sketch(b)) <= differ


def test_nothing_has_no_components(nothing):
    assert jaccard_components(nothing).count() == 0


def test_rows_without_an_id_keep_their_links(spark):
    words = [f"w{i}" for i in range(1200)]
    first, last = [f"b{i}" for i in range(90)], [f"c{i}" for i in range(90)]
    near = [" ".join(x) for x in (words, first + words[90:], first + words[90:-90] + last)]
    rows = [(1, near[0]), (None, near[1]), (3, near[2]), (None, "other words " * 9), (None, "other words " * 9), (4, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    rule = Rule(5, 8, 10)
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(frame, rule).collect()), key=str)
    # The middle text is close to both others, which are not close to each other.
    assert found == sorted(
        [(1, 1196, 1), (None, 1196, 1), (3, 1196, 1), (None, 2, None), (None, 2, None), (4, 0, 4), (None, 0, None)], key=str
    )


def test_long_chains_and_stars_are_connected(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    frame = spark.createDataFrame(chain, "a long, b long")
    found = {r["node"]: r["component"] for r in components(frame).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}
    assert components(frame.limit(0)).count() == 0


def _brute(texts, length):
    owner, out = {}, []
    order = sorted(texts, key=lambda r: suffixes._NO_ID if r[0] is None else r[0])
    for i, t in order:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            owner.setdefault(b[k : k + length], i)
    for i, t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            first = owner[b[k : k + length]]
            if first is not None and (i is None or first < i):
                gone[k : k + length] = b"\1" * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length, gram, hot", [(50, 20, 32), (12, 5, 32), (50, 20, 2), (12, 5, 1)])
def test_repeats_agree_with_brute_force(docs, texts, length, gram, hot, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_CHUNKS", hot)  # 1: every repeated anchor is split
    found = suffixes.without_repeats(docs, length, gram).drop("kept").collect()
    assert sorted((tuple(r) for r in found), key=str) == _brute(texts, length)


def _groups(documents: int, chunks: int, buckets: int) -> list[int]:
    """Bytes of contexts in each bucket, with two short lines in every document."""
    rng = np.random.default_rng(documents)
    other = lambda n: "".join(map(chr, rng.integers(33, 127, n)))
    lines = "a line of thirty bytes, or so..", "this line has just forty-nine bytes, and no more!"
    texts = [f"{other(60)}\n{lines[0]}\n{other(60)}\n{lines[1]}\n{other(60)}" for _ in range(documents)]
    parts = []
    for k in range(chunks):
        ids = list(range(k, documents, chunks))
        table = pa.table({"doc_id": ids, "text": [texts[i] for i in ids]})
        parts.append(suffixes.Chunk(table, 50, 20))
    by_bucket = lambda table: [
        table.filter(pc.equal(table["bucket"], b)) for b in pc.unique(table["bucket"]).to_pylist()
    ]
    anchors = pa.concat_tables([suffixes._anchors(k, c, buckets) for k, c in enumerate(parts)])
    repeated = pa.concat_tables([suffixes._repeated(t) for t in by_bucket(anchors)])
    contexts = pa.concat_tables(
        [suffixes._contexts(k, c, repeated.filter(pc.equal(repeated["chunk"], k)), buckets) for k, c in enumerate(parts)]
    )
    return [sum(map(len, t["text"].to_pylist())) for t in by_bucket(contexts)]


def test_no_bucket_grows_with_a_line_that_every_document_has(monkeypatch):
    # As many chunks and buckets for a document, as the operator chooses them.
    small, large = _groups(400, 40, 40), _groups(3200, 320, 320)
    assert sum(large) > 6 * sum(small)
    assert max(large) < 2 * max(small)
    monkeypatch.setattr(suffixes, "HOT_CHUNKS", 10**9)
    whole = _groups(3200, 320, 320)
    assert max(whole) > 3 * max(large)  # what one group held before


def test_repeats_with_null_ids_and_bytes_kept(spark, nothing):
    rows = [(None, "z" * 60), (4, "z" * 60), (4, "q" * 55), (4, "q" * 55), (9, "q" * 54 + "!")]
    found = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_bytes=True)
    assert sorted(((r["doc_id"], r["n_removed"], bytes(r["kept"])) for r in found.collect()), key=str) == sorted(
        [(None, 60, b""), (4, 0, b"z" * 60), (4, 0, b"q" * 55), (4, 0, b"q" * 55), (9, 54, b"!")], key=str
    )
    assert suffixes.without_repeats(nothing).count() == 0


def test_suffix_array_sorts():
    rng = np.random.default_rng(5)
    for n, symbols in ((1, 2), (200, 2), (500, 3), (2000, 200)):
        text = rng.integers(0, symbols, n).astype(np.uint8)
        raw = text.tobytes() + bytes(64)
        keys = [raw[i : i + 50] for i in suffixes.suffix_array(text, 50)]
        assert keys == sorted(keys) and len(keys) == n


def test_owners_of_equal_strings():
    text = np.frombuffer(b"abcabcab", np.uint8)
    owner = np.array([5, 6, 5, 7, 4, 3, 3, 3])
    valid = np.array([1, 1, 1, 1, 1, 0, 0, 0], bool)
    assert suffixes.smallest_owner(text, owner, valid, 3)[valid].tolist() == [5, 4, 5, 5, 4]


def test_an_anchor_with_one_context_is_not_split():
    rng = np.random.default_rng(11)
    passage = "".join(map(chr, rng.integers(33, 127, 400)))
    tables = [pa.table({"doc_id": [i, 1000 + i], "text": [passage, passage]}) for i in range(64)]
    chunks = [suffixes.Chunk(t, 50, 20) for t in tables]
    anchors = pa.concat_tables([suffixes._anchors(k, c, 1) for k, c in enumerate(chunks)])
    repeated = suffixes._repeated(anchors)
    sent = [
        suffixes._contexts(k, c, repeated.filter(pc.equal(repeated["chunk"], k)), 1) for k, c in enumerate(chunks)
    ]
    for table, c in zip(sent, chunks, strict=True):
        places = len(c.first) // 2
        assert len(table["hash"][0].as_py()) == 8 * places  # each context once, no string of its own
        packed = suffixes._packed(table)
        assert suffixes._unpacked(packed).equals(table)
        assert packed["least"].nbytes < table["least"].nbytes


def test_a_bucket_is_sorted_in_parts(monkeypatch):
    rng = np.random.default_rng(12)
    passage = "".join(map(chr, rng.integers(33, 127, 20000)))
    chunks = [suffixes.Chunk(pa.table({"doc_id": [i], "text": [passage]}), 50, 20) for i in range(2)]
    repeated = suffixes._repeated(pa.concat_tables([suffixes._anchors(k, c, 1) for k, c in enumerate(chunks)]))
    sent = pa.concat_tables(
        [suffixes._contexts(k, c, repeated.filter(pc.equal(repeated["chunk"], k)), 1) for k, c in enumerate(chunks)]
    )
    sorted_at_once = []
    smallest_owner = suffixes.smallest_owner
    monkeypatch.setattr(
        suffixes, "smallest_owner", lambda text, *more: sorted_at_once.append(len(text)) or smallest_owner(text, *more)
    )
    owners = suffixes._owners(sent, 50)
    assert max(sorted_at_once) < sum(sorted_at_once) / 8
    assert [r["n_removed"] for r in suffixes._cut(chunks[1], owners.filter(pc.equal(owners["chunk"], 1)), False).to_pylist()] == [20000]


def _sent(texts_of_chunks, buckets=1):
    chunks = [suffixes.Chunk(pa.table({"doc_id": ids, "text": texts}), 50, 20) for ids, texts in texts_of_chunks]
    anchors = pa.concat_tables([suffixes._anchors(k, c, buckets) for k, c in enumerate(chunks)])
    repeated = suffixes._repeated(anchors)
    return chunks, [
        suffixes._contexts(k, c, repeated.filter(pc.equal(repeated["chunk"], k)), buckets) for k, c in enumerate(chunks)
    ]


def _bytes(tables, name):
    return sum(len(x) for t in tables for x in t[name].to_pylist())


def test_the_bytes_of_a_context_are_sent_once():
    rng = np.random.default_rng(13)
    passage = "".join(map(chr, rng.integers(33, 127, 3000)))
    once = _bytes(_sent([([0], [passage]), ([1], [passage])])[1], "text")
    chunks, sent = _sent([([k], [passage]) for k in range(20)])
    assert _bytes(sent, "text") == once
    owners = suffixes._owners(pa.concat_tables(sent[::-1]), 50)
    for k, c in enumerate(chunks):
        cut = suffixes._cut(c, owners.filter(pc.equal(owners["chunk"], k)), True).to_pylist()
        assert [r["kept"] for r in cut] == [passage.encode() if k == 0 else b""]


def test_an_anchor_alone_does_not_make_a_context_stay():
    rng = np.random.default_rng(14)
    other = lambda n: "".join(map(chr, rng.integers(33, 127, n)))
    words = "twenty-five bytes or so.."
    rows = [([k], [other(200) + words + other(200)]) for k in range(6)]
    assert _bytes(_sent(rows)[1], "hash") < 8 * 6  # a byte of a side may agree by chance
    shared = other(12) + words + other(13)
    found = _sent([([k], [other(200) + shared + other(200)]) for k in range(6)])[1]
    assert all(t.num_rows for t in found)


def test_texts_of_a_chunk_are_packed():
    batch = pa.RecordBatch.from_pydict(
        {
            "chunk": pa.array([4, 2, 4, 4, 2], pa.int64()),
            "doc_id": pa.array([1, None, None, 7, 3], pa.int64()),
            "text": ["one é" * 200, None, "", None, "two"],
        }
    )
    packed = pa.Table.from_batches(suffixes._packed_texts([batch, batch.slice(0, 0), batch.slice(3)]))
    chunk = lambda k: suffixes._unpacked_texts(packed.filter(pc.equal(packed["chunk"], k))).to_pydict()
    assert chunk(4) == {"doc_id": [1, None, 7, 7], "text": [("one é" * 200).encode(), b"", b"", b""]}
    assert chunk(2) == {"doc_id": [None, 3, 3], "text": [b"", b"two", b"two"]}
    assert packed["text"].nbytes < 400
