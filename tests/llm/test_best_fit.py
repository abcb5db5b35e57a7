from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from breachscope.llm import best_fit, kernel, tokens
from breachscope.llm.queries import tokenizer_path

PATH = "byte_bpe_50k.json"


def one_by_one(counts: dict[int, int], length: int) -> Counter:
    """Best-fit decreasing, piece after piece: how many sequences end with each fill."""
    left: list[int] = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fits = [(room, i) for i, room in enumerate(left) if room >= size]
            if fits:
                left[min(fits)[1]] -= size
            else:
                left.append(length - size)
    return Counter(length - room for room in left)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12), st.integers(40, 90))
def test_runs_are_the_packing_of_single_pieces(counts, length):
    runs, bins = best_fit.best_fit(counts, length)
    places = best_fit.Places(runs)
    held = defaultdict(list)
    for size, n in counts.items():
        found, offset = places.find(np.full(n, size), np.arange(n))
        for b, o in zip(found.tolist(), offset.tolist(), strict=True):
            held[b].append((o, size))
    assert sorted(held) == list(range(bins))
    for pieces in held.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *[s for _, s in pieces]])[:-1].tolist()
    assert Counter(sum(s for _, s in p) for p in held.values()) == one_by_one(counts, length)


def test_the_tree_finds_the_tightest():
    tree = best_fit.OpenBins(100)
    for c in (3, 40, 41, 100):
        tree.mark(c, True)
    assert [tree.tightest(c) for c in (1, 3, 4, 41, 42, 100)] == [3, 3, 40, 41, 100, 100]
    tree.mark(100, False)
    assert tree.tightest(42) is None


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(PATH))


PARTS = ["a", "Bc", "é", "12", "½", " ", "  ", "\n", "\t", " ", " ", "　", "\u0085", "'s", "'", "'ll", "!", ".,",
         "日本", "👍🏽", "́", "ß", "\x1c", "\x00", "<|endoftext|>", "<|", "\r\n", "​", " ", " ", "_", "x²"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=20).map("".join), min_size=1, max_size=6))
def test_units_give_the_ids_of_the_plain_call(tokenizer, rows):
    encoder = tokens.unit_encoder(tokenizer_path(PATH))
    raw = [r.encode() for r in rows]
    ids, counts = encoder.encode(raw, tokens.spaced_units(raw))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [tokenizer.encode(r, add_special_tokens=False).ids for r in rows]


def test_pieces_hold_every_token_once(spark, docs, texts, nothing, tokenizer, monkeypatch):
    docs = docs.union(docs.where("doc_id is null or doc_id < 3").selectExpr("null", *[f"`{c}`" for c in docs.columns[1:]]))
    texts = texts + [(None, t) for i, t in texts if i is None or i < 3]
    expected = Counter()
    for i, t in texts:
        expected[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])] += 1
    for entries in (best_fit._BROADCAST_ENTRIES, 0):  # by broadcast, and by a shuffle
        monkeypatch.setattr(best_fit, "_BROADCAST_ENTRIES", entries)
        pieces = best_fit.pack(docs.repartition(5), tokenizer_path(PATH), length=64).collect()
        sequences, of_doc = defaultdict(list), defaultdict(list)
        for r in pieces:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
            assert len(r["ids"]) == 4 * r["length"] and 0 < r["length"] <= 64
            assert r["length"] == 64 or r["piece"] == 0
            of_doc[r["doc_id"]].append((r["piece"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        for held in sequences.values():
            held.sort()
            assert [o for o, _ in held] == np.cumsum([0, *[n for _, n in held]])[:-1].tolist()
            assert sum(n for _, n in held) <= 64
        single = {i for (i, _), n in expected.items() if sum(m for (j, _), m in expected.items() if j == i) == 1}
        for i in single:
            found = sorted(of_doc[i])
            assert [p for p, *_ in found] == list(range(len(found)))
            assert [s for _, s, _ in found] == np.cumsum([0, *[len(x) for *_, x in found]])[:-1].tolist()
            assert expected[i, tuple(x for *_, ids in found for x in ids)] == 1
        heads = Counter((len(ids) - 1) % 64 + 1 for (_, ids), n in expected.items() for _ in range(n))
        full = sum(((len(ids) - 1) // 64) * n for (_, ids), n in expected.items())
        fills = Counter(sum(n for _, n in held) for held in sequences.values())
        assert fills == one_by_one(heads, 64) + Counter({64: full})
        # All tokens, of rows with a repeated or null id too.
        tokens_of = Counter(x for (_, ids), n in expected.items() for _ in range(n) for x in ids)
        assert Counter(x for found in of_doc.values() for *_, ids in found for x in ids) == tokens_of
    assert best_fit.pack(nothing, tokenizer_path(PATH)).count() == 0


def test_blocks_of_text_follow_their_bytes():
    import pyarrow as pa

    column = pa.array(["aa", None, "bbb", "", "c" * 9, "d"]).slice(1)
    assert list(kernel.text_blocks(column, 4)) == [(0, [b"", b"bbb", b""]), (3, [b"c" * 9]), (4, [b"d"])]
    assert list(kernel.text_blocks(pa.array([], pa.string()), 4)) == []
