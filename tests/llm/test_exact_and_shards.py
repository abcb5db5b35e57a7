import hashlib
import zlib
from collections import defaultdict

from breachscope.llm.exact_dedup import exact_duplicates
from breachscope.llm.sharding import SlotMap, balanced_map, rebalanced_map, shard, write_shards


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_duplicates_agree_with_brute_force(spark, docs, texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[_lower(t)].append(i)
    expected = sorted(
        (i, max(groups[_lower(t)]), len(groups[_lower(t)]), i == max(groups[_lower(t)]),
         hashlib.sha256(_lower(t).encode()).hexdigest())
        for i, t in texts
    )
    for words in (2_000_000, 0):  # broadcast and joined filter
        found = sorted(tuple(r) for r in exact_duplicates(docs, broadcast_words=words).collect())
        assert found == expected


def test_exact_duplicates_of_nothing_and_of_null_ids(spark, nothing):
    assert exact_duplicates(nothing).count() == 0
    rows = spark.createDataFrame([(None, "a"), (None, "A"), (1, "b")], "doc_id long, text string")
    found = {tuple(r)[:4] for r in exact_duplicates(rows).collect()}
    assert found == {(None, None, 2, True), (1, 1, 1, True)}


def test_shards_have_near_equal_bytes_and_gapless_slots(docs, texts):
    rows = shard(docs, 4, slots=512).collect()
    assert len(rows) == len(texts)
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= largest
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add((r["size"], r["text_crc32"]))
    for i, t in texts:
        raw = (t or "").encode()
        assert (len(raw) + 16, zlib.crc32(raw)) in by_id[i]


def test_shards_of_nothing(nothing):
    assert shard(nothing, 3).count() == 0


def test_rebalancing_moves_little_and_balances():
    sizes = [(i * 7919) % 97 + 1 for i in range(400)]
    old = balanced_map(sizes, 8)
    held = lambda m: [sum(s for s, x in zip(sizes, m.shard_of) if x == k) for k in range(m.shards)]
    assert max(held(old)) - min(held(old)) <= max(sizes)
    grown = rebalanced_map(old, sizes, 9)
    assert grown.version == 2 and max(held(grown)) - min(held(grown)) <= max(sizes)
    moved = sum(a != b for a, b in zip(old.shard_of, grown.shard_of))
    assert moved <= 400 / 9 * 1.6
    shrunk = rebalanced_map(grown, sizes, 8)
    assert set(shrunk.shard_of) == set(range(8))
    assert rebalanced_map(old, sizes, 8).shard_of == old.shard_of


def test_written_shards_hold_every_row_once(spark, docs, texts, tmp_path):
    where = SlotMap(1, 3, tuple(v % 3 for v in range(64)))
    write_shards(docs, where, str(tmp_path / "s"), slots=64)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select("doc_id", "text").collect())) == sorted(
        map(str, docs.select("doc_id", "text").collect())
    )
