import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from breachscope.llm import licenses, line_dedup, url_filter
from tests.llm.conftest import WORDS


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _words(line):
    return "".join(c if c.isalnum() else " " for c in line.lower()).split()


def _linked(a: list[str], b: list[str]) -> bool:
    longer = max(len(a), len(b))
    return a == b or longer >= line_dedup.MIN_WORDS and _distance(a, b) <= int(longer * 0.2 + 1e-9)


def _kept_lines(texts, body_of):
    """By definition, from all pairs of distinct lines."""
    lines = [
        ((i is None, i, body_of[i, t], pos), " ".join(_words(line)))
        for i, t in texts
        for pos, line in enumerate((t or "").split("\n"))
        if _words(line)
    ]
    distinct = sorted({n for _, n in lines})
    up = {n: n for n in distinct}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if _linked(a.split(), b.split()):
                up[root(a)] = root(b)
    stays = {}
    for key, n in sorted(lines, key=lambda x: (x[0][0], x[0][1] or 0, *x[0][2:])):
        stays.setdefault(root(n), key)
    gone = defaultdict(set)
    for key, n in lines:
        if stays[root(n)] != key:
            gone[key[1:3]].add(key[3])
    return gone


def _bodies(docs):
    return {(r["doc_id"], r["text"]): r["b"] for r in docs.select("doc_id", "text", F.xxhash64("text").alias("b")).collect()}


def test_line_groups_agree_with_brute_force(spark, docs, texts):
    found = line_dedup.deduplicate_lines(docs)
    assert found.columns == [c for c in docs.columns] + ["n_lines", "n_removed"]
    result = sorted(((r["doc_id"], r["text"], r["n_removed"]) for r in found.collect()), key=str)
    body_of = _bodies(docs)
    gone = _kept_lines(texts, body_of)
    expected = []
    for i, t in texts:
        drop = gone[i, body_of[i, t]]
        kept = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in drop)
        expected.append((i, kept, len(drop)))
    assert sum(n for *_, n in expected) > 20
    assert result == sorted(expected, key=str)


def test_lines_with_edits_of_every_kind_and_length_are_linked(spark):
    """Words changed, dropped and added, up to the bound and beyond, in short and long
    lines; signs, case, and letters that are words of their own."""
    rng, texts = random.Random(8), []
    for n in (4, 5, 6, 9, 10, 14, 15, 24, 60):
        words = [rng.choice(WORDS) for _ in range(n)]
        for k in range(int(n * 0.2) + 2):
            for kind in range(4):
                line = list(words)
                for at in sorted(rng.sample(range(len(line)), min(k, len(line))), reverse=True):
                    change = rng.randrange(3) if kind == 3 else kind
                    if change == 0:
                        line[at] = rng.choice(WORDS)
                    elif change == 1:
                        del line[at]
                    else:
                        line.insert(at, rng.choice(WORDS))
                texts.append((len(texts), " ".join(line) if kind else ", ".join(line).upper() + "."))
    zh = "这是一个很长的句子里面没有空格"
    texts += [(len(texts), zh), (len(texts) + 1, zh.replace("长", "短")), (len(texts) + 2, zh[:7])]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    body_of = _bodies(rows)
    brute = [(i, re.sub("([\u4e00-\u9fff])", r" \1 ", t)) for i, t in texts]
    gone = _kept_lines(brute, {(i, b): body_of[i, t] for (i, t), (_, b) in zip(texts, brute)})
    found = {r["doc_id"]: r["n_removed"] for r in line_dedup.deduplicate_lines(rows).collect()}
    assert found == {i: len(gone[i, body_of[i, t]]) for i, t in texts}
    assert 30 < sum(found.values()) < len(texts) - 10


def test_line_dedup_of_nothing_and_of_one_line_documents(spark, nothing):
    assert line_dedup.deduplicate_lines(nothing).count() == 0
    same = "one two three four five six"
    rows = spark.createDataFrame([(2, same), (1, same.upper()), (None, same), (3, "a b\na b")], "doc_id long, text string")
    found = {(r["doc_id"], r["text"]) for r in line_dedup.deduplicate_lines(rows).collect()}
    assert found == {(1, same.upper()), (2, ""), (None, ""), (3, "a b")}


_ENTRIES = [
    ("example.com", "block", "2024-01-10"),
    ("example.com", "remove", "2024-02-10"),
    ("good.example.com", "allow", "2024-01-20"),
    ("good.example.com/bad", "block", "2024-01-25"),
    ("twice.org", "block", "2024-01-01"),
    ("twice.org", "remove", "2024-01-01"),
    (None, "block", "2024-01-01"),
]


def _decide(spark, urls):
    entries = spark.createDataFrame(_ENTRIES, "pattern string, action string, day string").select(
        "pattern", "action", F.to_date("day").alias("listed_at")
    )
    captures = spark.createDataFrame(urls, "page_id long, url string, day string").select(
        "page_id", "url", F.to_date("day").alias("fetched_at"), F.lit(1).alias("pattern"), F.lit(2).alias("host")
    )
    both = [url_filter.filter_urls(captures, entries, broadcast_entries=n) for n in (10, 0)]
    rows = [sorted((tuple(r) for r in f.collect()), key=str) for f in both]
    assert rows[0] == rows[1]
    return [(r[0], r[4], r[6]) for r in sorted(rows[0], key=lambda r: r[0] or 0)]


def test_the_entry_valid_at_the_time_of_the_fetch_decides(spark):
    urls = [
        (1, "http://a.example.com/x", "2024-01-09"),
        (2, "http://a.example.com/x", "2024-01-10"),
        (3, "https://u:p@WWW.EXAMPLE.com:80", "2024-02-09"),
        (4, "http://a.example.com/x", "2024-02-10"),
        (5, "http://good.example.com/ok", "2024-01-22"),
        (6, "http://good.example.com/bad/deep?q", "2024-01-26"),
        (7, "http://twice.org", "2024-03-01"),
        (8, "no url", "2024-01-15"),
        (9, None, "2024-01-15"),
        (10, "http://example.com/", None),
        (11, "http://com/" + "a/" * 5000, "2024-01-15"),
        (11, "http://com/" + "a/" * 5000, "2024-01-15"),
    ]
    assert _decide(spark, urls) == [
        (1, False, None), (2, True, "example.com"), (3, True, "example.com"), (4, False, None),
        (5, False, "good.example.com"), (6, True, "good.example.com/bad"), (7, False, None),
        (8, False, None), (9, False, None), (10, False, None), (11, False, None), (11, False, None),
    ]
    assert _decide(spark, urls[:0]) == []


def _scanned(spark, rows):
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted((tuple(r) for r in found), key=str)


def test_licenses_are_found_in_any_spelling(spark, docs, nothing):
    mit = "MIT License\n\n" + licenses.WHOLE["MIT"]
    rows = [
        (1, mit), (2, "Copyright (c) 2020 Someone\n" + mit.upper().replace(",", " ;")),
        (3, "prose\nLicensed under the APACHE LICENCE, v. 2.0!\nmore"), (4, "Released under the MIT Licence."),
        (5, mit + " more"), (6, None), (7, ""), (8, "CC BY-NC 4.0\nMIT License\nMIT License"),
        (8, "CC BY-NC 4.0\nMIT License\nMIT License"), (None, "MIT License"),
    ]
    assert _scanned(spark, rows) == sorted([
        (1, "MIT", "MIT", 1), (2, "MIT", "MIT", 1), (3, None, "Apache-2.0", 1), (4, "MIT", "MIT", 1),
        (5, None, "MIT", 1), (6, None, "", 0), (7, None, "", 0), (8, None, "CC-BY-NC-4.0,MIT", 6),
        (8, None, "CC-BY-NC-4.0,MIT", 6), (None, "MIT", "MIT", 1),
    ], key=str)
    assert licenses.scan(docs).count() == docs.count() and licenses.scan(nothing).count() == 0


def test_every_licence_is_found_whole_retitled_and_inside_a_longer_file(spark):
    import textwrap

    texts = {name: text for name, text in licenses.known_texts() if len(text) > 600}
    assert len(texts) >= 17
    rows, expected = [], {}
    for i, (name, text) in enumerate(sorted(texts.items())):
        # Lines broken elsewhere, but for those of a copyright notice.
        narrow = "\n".join(p if "copyright (c)" in p.lower() else textwrap.fill(p, 50) for p in text.split("\n\n"))
        rows += [
            (10 * i, text), (10 * i + 1, narrow.upper().replace("LICENSE", "LICENCE")),
            (10 * i + 2, "A readme.\nSome words of it.\n\nCopyright (c) 2001 Me\n" + narrow + "\nAnd more\n"),
            (10 * i + 3, "# prose\n" + "\n".join("# " + line for line in narrow.split("\n"))),
            (10 * i + 4, text[: len(text) // 2] + " changed " + text[len(text) // 2 :]),
        ]
        expected |= {10 * i: (name, True), 10 * i + 1: (name, True), 10 * i + 2: (name, False), 10 * i + 3: (name, False)}
    for doc_id, whole, found, _ in _scanned(spark, rows):
        name, entire = expected.get(doc_id, (None, False))
        assert whole == (name if entire else None), (name, doc_id)
        assert name is None or name in found.split(","), (name, doc_id)
    titled = [(i, f"{t}\n\nCopyright 1999 X\n\n{licenses.WHOLE[n]}") for i, (n, t) in enumerate((n, t) for n, ts in licenses.TITLES.items() for t in ts)]
    names = [n for n, ts in licenses.TITLES.items() for _ in ts]
    assert [(r[0], r[1]) for r in sorted(_scanned(spark, titled))] == list(enumerate(names))


def test_heads_of_files_are_found(spark):
    import textwrap

    head = {
        "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        **licenses.HEADERS,
    }
    rows = [
        (i, "/*\n" + textwrap.indent(textwrap.fill(text, 60), " * ") + "\n */\nint main;\n") for i, text in enumerate(head.values())
    ]
    assert [(r[0], r[2]) for r in sorted(_scanned(spark, rows))] == list(enumerate(head))


def test_lines_are_linked_by_their_words_alone(spark):
    """Recall by length, against lines made with as many edits as are allowed."""
    rng = random.Random(6)
    rows, linked = [], set()
    for i, n in enumerate((5, 6, 9, 10, 14, 20, 24, 40, 80, 5, 10, 20, 40, 80)):
        words = [rng.choice(WORDS) for _ in range(n)]
        other, k = list(words), int(n * 0.2 + 1e-9)
        for j, at in enumerate(rng.sample(range(n), k)):
            other[at] = f"new{i}x{j}" if i % 3 else rng.choice(WORDS)
        if n >= 10 and i % 2:
            del other[rng.randrange(n)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        if _distance(words, other) <= k:
            linked.add(2 * i + 1)
    found = line_dedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(linked) > 8 and {r["doc_id"] for r in found.where("n_removed > 0").collect()} == linked


def test_short_lines_and_lines_without_blanks_are_grouped(spark):
    han = "".join(chr(0x4E00 + 7 * i) for i in range(30))
    rows = [
        (1, "Of edti oner\n---\n" + han), (2, "of edti, oner!\n---\nof edti two"), (3, han[:10] + "\u9fa0" + han[11:]),
        (4, "\u4e00\u4e01\u4e02"), (5, "\u4e00\u4e01\u4e02"), (6, "\u4e00\u4e01\u4e03"),
    ]
    found = line_dedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = {r["doc_id"]: r["text"] for r in found.collect()}
    assert kept == {1: rows[0][1], 2: "---\nof edti two", 3: "", 4: rows[3][1], 5: "", 6: rows[5][1]}


def test_an_entry_of_one_label_holds_for_all_hosts_below_it(spark):
    entries = spark.createDataFrame([("test", "block", "2024-01-01"), ("a.test", "allow", "2024-01-01")], "pattern string, action string, day string")
    pages = spark.createDataFrame([(1, "http://x.b.test/"), (2, "http://x.a.test/"), (3, "http://x.org/")], "page_id long, url string")
    found = url_filter.filter_urls(
        pages.withColumn("fetched_at", F.lit("2024-02-01").cast("date")),
        entries.select("pattern", "action", F.col("day").cast("date").alias("listed_at")),
    )
    assert {(r["page_id"], r["blocked"]) for r in found.collect()} == {(1, True), (2, False), (3, False)}


def test_lines_that_repeat_other_words_are_no_candidates(spark, monkeypatch):
    # An even number of each word leaves no parity bit; all lines have one pair of words in common.
    lines = [" ".join(["to"] * 30 + [f"word{i}"] * 30) for i in range(40)]
    lines += [lines[0] + " end", " ".join(["so"] + lines[1].split()[1:])]
    looked_at = []
    similar = line_dedup._similar

    def counted(pairs, *args):
        looked_at.append(pairs.count())
        return similar(pairs, *args)

    monkeypatch.setattr(line_dedup, "_similar", counted)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_removed"] for r in line_dedup.deduplicate_lines(docs).collect()}
    assert sorted(i for i, n in found.items() if n) == [40, 41]
    assert sum(looked_at) < 40 * 39 / 2 / 4
