import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from breachscope.llm import decontamination, kernel, language, packing, tokens
from breachscope.llm.queries import tokenizer_path
from tests.llm.conftest import WORDS, prose


def test_words_and_shingles_are_those_of_python():
    rows = [b"Ab  cD\te\n", b"", b"one", "é ï ö\x0b1 2".encode(), b" x "]
    words = kernel.Words(rows)
    spans = [bytes(words.bytes[a:b]) for a, b in zip(words.starts, words.ends)]
    assert spans == [w for r in rows for w in r.lower().split()]
    hashes, bounds = words.shingles(3)
    assert np.diff(bounds).tolist() == [1, 0, 1, 3, 1]
    assert len(set(hashes.tolist())) == len(hashes)


def _best(pattern, text):
    row = list(range(len(pattern) + 1))
    best = (row[-1], 0)
    for j, y in enumerate(text, 1):
        last, row[0] = 0, 0
        for i, x in enumerate(pattern, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (x != y))
        best = min(best, (row[-1], j))
    return best


def test_bit_parallel_distance_is_the_edit_distance():
    rng = np.random.default_rng(0)
    for _ in range(300):
        p = rng.integers(0, 4, rng.integers(1, 90)).astype(np.uint64)
        t = rng.integers(0, 4, rng.integers(0, 120)).astype(np.uint64)
        assert decontamination.best_fit(p, t) == _best(p.tolist(), t.tolist())


def test_leaks_agree_with_brute_force(spark, nothing):
    rng = random.Random(3)
    items = [(i, prose(1000 + i, n, 9)) for i, n in enumerate((40, 25, 10, 6, 5, 4, 70))] + [(7, None), (8, ""), (9, prose(1000, 40, 9))]
    rows = []
    for d in range(40):
        item = items[d % 7][1].split()
        for _ in range(d // 8):
            k = rng.randrange(len(item))
            item[k : k + 1] = rng.choice([[], [rng.choice(WORDS)], [item[k], rng.choice(WORDS)]])
        rows.append((d, prose(d, rng.randrange(0, 60)) + "\n" + " ".join(item).title() + "! " + prose(d + 50, 30)))
    rows += [(40, None), (41, ""), (None, items[0][1]), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (t or "").lower()).split()
    expected = []
    for i, t in rows:
        for item, text in items:
            words = split(text)
            if len(words) < decontamination.MIN_WORDS:
                continue
            distance, _ = _best(words, split(t))
            if distance <= int(len(words) * 0.2 + 1e-9) and distance < len(words):
                expected.append((i, item, distance))
    found = decontamination.leaks(docs, bench)
    got = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in found.collect()), key=str)
    assert got == sorted(expected, key=str) and len(got) > 20
    clean = decontamination.without_leaks(docs, found)
    bad = {i for i, *_ in expected}
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows if i not in bad or i is None}
    assert decontamination.leaks(nothing, bench).count() == 0
    assert decontamination.leaks(docs, bench.limit(0)).count() == 0


def test_item_blocks_give_the_same_leaks(spark, docs, monkeypatch):
    bench = docs.where("doc_id < 12").select(F.col("doc_id").alias("item_id"), F.substring("text", 1, 300).alias("text"))
    whole = sorted(map(tuple, decontamination.leaks(docs, bench).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_TEXT", 700)
    assert sorted(map(tuple, decontamination.leaks(docs, bench).collect())) == whole and len(whole) >= 12


def test_language_is_learnt_from_allowed_rows_only(spark, sf_dir, nothing):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    poisoned = docs.withColumn("lang", F.when(language.held_out(), "xx").otherwise(F.col("lang")))
    model = language.fit(poisoned, ~language.held_out())
    assert "xx" not in model.labels and (model.weights == 0).mean() > 0.5
    rows = language.predict(docs, model).where(language.held_out()).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.95
    odd = spark.createDataFrame(
        [(1, None, 7, "a"), (2, "", 7, "b"), (3, "12 .,", 7, "c"), (4, "x" * 300_000, 7, "d")],
        "doc_id long, text string, score int, lang_pred string",
    )
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] in model.labels and 0 < got[4][1] <= 1
    assert language.predict(nothing, model).count() == 0
    assert language.fit(docs.limit(0), F.lit(True)) is None
    assert language.predict(docs, None).where("lang_pred <> 'und'").count() == 0


def _plain_features(text: str) -> Counter:
    """Hashed n-grams of characters, one after the other."""
    chars = [48 if c in "0123456789" else 32 if 9 <= ord(c) <= 13 else ord(c) for c in text.lower()]
    out = Counter()
    for n in language.GRAMS:
        for i in range(len(chars) - n + 1):
            h = 0
            for k, c in enumerate(chars[i : i + n], 1):
                h = (h * 0x01000193 + c + k) % 2**32
            out[(h * 0x9E3779B1) % 2**32 >> 16] += 1
    return out


def test_features_are_character_ngrams_in_every_script():
    texts = ["Hello 42\tWorld", "", "a", "Ελληνικά και ΆΛΛΑ", "日本語テキスト", "İstanbul ß", "नमस्ते दुनिया", "👍🏽x"]
    found = list(language.feature_counts([t.encode() for t in texts]))
    assert [dict(zip(f.tolist(), c.tolist())) for f, c in found] == [dict(_plain_features(t)) for t in texts]
    assert language.FEATURES == 1 << 16


def test_one_epoch_is_the_plain_update_rule():
    """Weights from sums of gradients, one row and one coordinate at a time."""
    texts = [f"{w} {prose(i, 6)}" for i, w in enumerate(("ein haus", "une maison", "a house") * 5)]
    targets = np.array([0, 1, 2] * 5)
    idf = np.ones(language.FEATURES)
    rows = list(language.feature_counts([t.encode() for t in texts]))
    vectors = [(f, language._vector(f, c, idf)) for f, c in rows]
    for f, v in vectors:
        assert (v * v).sum() == pytest.approx(1)
    got, bias = language.train(vectors, targets, 3, alpha=0.4, beta=0.9, l1=0.03, l2=0.05, epochs=1)
    z, n = defaultdict(float), defaultdict(float)

    def weight(at, k):
        if abs(z[at, k]) <= 0.03:
            return 0.0
        return -(z[at, k] - math.copysign(0.03, z[at, k])) / ((0.9 + math.sqrt(n[at, k])) / 0.4 + 0.05)

    for i in np.random.default_rng(11).permutation(len(vectors)):
        x = [*zip(vectors[i][0].tolist(), vectors[i][1].tolist()), ("bias", 1.0)]
        w = {(at, k): weight(at, k) for at, _ in x for k in range(3)}
        score = [math.exp(sum(v * w[at, k] for at, v in x)) for k in range(3)]
        for at, v in x:
            for k in range(3):
                g = v * (score[k] / sum(score) - (k == targets[i]))
                sigma = (math.sqrt(n[at, k] + g * g) - math.sqrt(n[at, k])) / 0.4
                z[at, k] += g - sigma * w[at, k]
                n[at, k] += g * g
    for f, _ in vectors:
        assert np.allclose(got[f], [[weight(at, k) for k in range(3)] for at in f.tolist()], atol=1e-12)
    assert np.allclose(bias, [weight("bias", k) for k in range(3)]) and (got != 0).any()


def test_scripts_of_three_bytes_a_letter_are_told_apart(spark):
    letters = {"ja": "あいうえおかきくけこさしすせそ", "th": "กขคงจฉชซญดตถทธน", "hi": "कखगघचछजझटठडढतथद"}
    rng = random.Random(4)
    rows = [
        (i, "".join(rng.choice(letters[k]) + (" " if rng.random() < 0.2 else "") for _ in range(40)), k)
        for i, k in enumerate(list(letters) * 30)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.col("doc_id") < 60)
    found = language.predict(docs, model).where("doc_id >= 60").collect()
    assert all(r["lang_pred"] == r["lang"] and r["score"] > 0.5 for r in found)


def test_the_sample_is_bounded_in_features_and_labels(spark, monkeypatch):
    rows = [(i, prose(i, 40), "ab"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    small = language.fit(docs, F.lit(True), sample_features=3000)
    whole = language.fit(docs, F.lit(True))
    assert (small.weights != 0).any(axis=1).sum() < (whole.weights != 0).any(axis=1).sum()
    assert language.fit(docs, F.lit(True), sample_features=1).labels == ("a", "b")  # one row at least
    monkeypatch.setattr(language, "MAX_LABELS", 1)
    with pytest.raises(ValueError, match="more than 1 labels"):
        language.fit(docs, F.lit(True))


def test_training_separates_and_calibration_minds_errors():
    rng = np.random.default_rng(1)
    vectors, targets = [], []
    for i in range(200):
        y = i % 2
        found = np.unique(rng.integers(1000 * y, 1000 * y + 800, 40))
        vectors.append((found, np.full(len(found), len(found) ** -0.5)))
        targets.append(y)
    weights, bias = language.train(vectors, np.array(targets), 2)
    logits = np.array([v @ weights[f] + bias for f, v in vectors])
    assert (logits.argmax(1) == targets).all() and (weights != 0).any(1).sum() < 1700
    noisy = np.array(targets)
    noisy[:60] = 1 - noisy[:60]
    assert language.calibrate(logits, noisy) > language.calibrate(logits, np.array(targets))


def test_the_curve_visits_every_cell_once_and_moves_one_step():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = packing.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
        assert (steps == 1).all()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_units_give_the_ids_of_the_whole_text(tokenizer):
    rows = [
        "It's 3.14 (don't) we'll HELLO,world!! a.b-c_d x'y 'tis rock'n'roll''s",
        "naïve façade ñandú ÉCOLE étude  nbsp em\x1cfs\x85nel",
        "<|endoftext|> <|startoftext|> <| endoftext |> a<|endoftext|>b",
        "日本語テキスト 漢字 123१२३ ½ ﬁ Ω K İstanbul ΣΑΣ", "", "\x00\x01\x7f", "👍🏽 emoji👩‍👩‍👧 x≮y",
        "https://a.example.com/x?y=1&z=%20#t " * 5, "Ab1cd2'3e '' '",
    ]
    encoder = tokens.UnitEncoder(tokenizer_path())
    raw = [r.encode() for r in rows]
    for _ in range(2):  # the second time from the cache
        ids, counts = encoder.encode(raw, tokens.word_units(kernel.Words(raw)))
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [tokenizer.encode(r, add_special_tokens=False).ids for r in rows]


def test_an_emptied_cache_learns_again(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_UNITS", 5)
    encoder = tokens.UnitEncoder(tokenizer_path())
    for seed in range(5):
        text = prose(seed, 30) + " the same words " + prose(0, 10)
        raw = [text.encode()]
        ids, counts = encoder.encode(raw, tokens.word_units(kernel.Words(raw)))
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids and counts[0] == len(ids)


def test_pieces_hold_every_token_once(spark, docs, texts, nothing, tokenizer):
    pieces = packing.pack(docs, tokenizer_path(), length=256).collect()
    sequences, of_doc = defaultdict(list), defaultdict(list)
    for r in pieces:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        of_doc[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u2").tolist(), r["doc_tokens"]))
        assert len(r["ids"]) == 2 * r["length"] > 0
    for s, held in sequences.items():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *[n for _, n in held]])[:-1].tolist()
        assert sum(n for _, n in held) == 256 or s == max(sequences)
    expected = defaultdict(list)
    for i, t in texts:
        expected[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    for i, lists in expected.items():
        # A repeated id: its documents' tokens together, whatever the order.
        assert sorted(x for _, ids, _ in of_doc[i] for x in ids) == sorted(x for ids in lists for x in ids)
        if len(lists) == 1:
            assert [x for _, ids, _ in sorted(of_doc[i]) for x in ids] == lists[0]
            assert {n for *_, n in of_doc[i]} == {len(lists[0])}
    assert packing.pack(nothing, tokenizer_path()).count() == 0
    crc = packing.wide_crc(packing.pack(docs.where("doc_id = 3"), tokenizer_path())).first()
    assert crc["ids_crc32"] == zlib.crc32(np.array(expected[3][0], "<u4").tobytes())
