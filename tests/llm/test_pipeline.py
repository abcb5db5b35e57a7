import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from breachscope.llm import decontamination, language, line_dedup
from breachscope.llm.jaccard import jaccard_components
from breachscope.llm.queries import tokenizer_path
from breachscope.session import shared_folder, work


def test_each_stage_keeps_clean_documents_and_acts_on_the_others(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(docs.limit(1).select(
        F.lit(900_001).cast("long").alias("doc_id"), F.lit("12 34").alias("text"), F.lit(None).cast("string").alias("lang"),
        "source", F.lit(5).cast("long").alias("n_chars"),
    ))
    kept = {}
    for name, stage in P.STAGES:
        before = docs
        docs = stage(spark, docs, sf_dir)
        if name != "packing":
            assert docs.columns == P.COLUMNS == list(before.columns)
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
    before = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert kept["language_id"] == before
    assert kept["line_dedup"] == before
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    found = jaccard_components(read("line_dedup")).collect()
    assert kept["jaccard_join"] == {r["component_id"] for r in found}
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaked = {r["doc_id"] for r in decontamination.leaks(read("jaccard_join"), items).collect()}
    assert leaked and kept["decontamination"] == kept["jaccard_join"] - leaked
    assert kept["packing"] == kept["decontamination"]
    lines = line_dedup.deduplicate_lines(read("language_id"))
    assert sorted(map(str, lines.select("doc_id", "text").collect())) == sorted(
        map(str, read("line_dedup").select("doc_id", "text").collect())
    )
    assert language.UNKNOWN == "und" and [n for n, _ in P.STAGES] == [
        "language_id", "line_dedup", "jaccard_join", "decontamination", "packing"
    ]


def test_no_documents_give_no_pieces(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_rows_are_kept_or_dropped_by_row_not_by_id(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first()["text"]
    one, two, three = (" ".join(f"{x}{i}word" for i in range(60)) for x in "abc")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    kept = lambda stage, rows: sorted(((r["doc_id"], r["text"]) for r in stage(spark, frame(rows), sf_dir).collect()), key=str)
    near = [(2, one), (2, one), (None, one), (1, one), (1, two), (3, two), (None, three), (None, three)]
    assert kept(P.remove_near_copies, near) == [(1, one), (1, two), (None, three)]
    assert kept(P.remove_benchmarks, [(None, item), (5, item), (5, two), (None, one)]) == [(5, two), (None, one)]


def _tables(spark):
    folder = Path(shared_folder(spark)) / "breachscope" / spark.sparkContext.applicationId
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_a_stage_removes_what_the_one_before_left(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    others, left = _tables(spark), []
    with work(spark, P._WORK):
        others = _tables(spark)  # of frames that have nothing to do with the pipeline
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left.append(_tables(spark) - others)
    for before, after in zip(left, left[1:]):
        assert not before & after
    assert max(map(len, left)) <= 16
    with work(spark, P._WORK, docs):
        assert _tables(spark) == others
    # A frame that is still to be read keeps its tables.
    rows = spark.read.parquet(str(tmp_path / "docs"))
    unread = P.remove_repeated_lines(spark, rows, sf_dir)
    kept = P.remove_benchmarks(spark, unread, sf_dir)
    assert kept.count() > 0


def test_run_stores_its_result_and_nothing_else(spark, sf_dir):
    before = _tables(spark)
    pieces = P.run(spark, sf_dir)
    assert len(_tables(spark) - before) == 1 and pieces.count() > 0


def test_every_stage_takes_null_and_repeated_ids(spark, sf_dir):
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang = 'en' AND n_chars > 400").orderBy("doc_id").first()["text"]
    other = "\n".join(f"some other words of line {w} that say {w} {w}s here" for w in ("one", "two", "red", "blue"))
    rows = [(None, text, "en"), (None, text, None), (7, text, "en"), (7, other, "en"), (7, other, "en"), (None, None, None), (8, "", "en")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, k, "s", None) for i, t, k in rows], schema)
    ids = lambda df: sorted((str(r["doc_id"]) for r in df.collect()))
    known = P.identify_language(spark, docs, sf_dir)
    assert ids(known) == ["7", "7", "7", "None", "None"]  # null and empty texts have no language
    lines = P.remove_repeated_lines(spark, docs, sf_dir).collect()
    assert len(lines) == len(rows) and sum(r["text"] == other for r in lines) == 2
    assert [r["n_chars"] for r in lines if r["text"] is None] == [None]
    assert len(ids(P.remove_near_copies(spark, docs, sf_dir))) == 4  # two texts, null, empty
    assert len(ids(P.remove_benchmarks(spark, docs, sf_dir))) == len(rows)
    pieces = P.pack_sequences(spark, docs, sf_dir).collect()
    assert sum(r["length"] for r in pieces if r["start"] == 0 and r["doc_tokens"] == 1) == 2
    assert sum(r["start"] == 0 for r in pieces) == len(rows)


def test_the_packed_sequences_have_their_token_ids(spark, sf_dir):
    texts = ["Some words of one text, and more of them. " * 40, "", None, "two ünïcode lines\nof 12 words"] * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], schema)
    encoder = Tokenizer.from_file(tokenizer_path())
    made = {}
    for r in P.pack_sequences(spark, docs, sf_dir).orderBy("doc_id", "start").collect():
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == r["length"] and zlib.crc32(ids.astype("<u4").tobytes()) == r["ids_crc32"]
        made[r["doc_id"]] = made.get(r["doc_id"], []) + ids.tolist()
    assert made == {i: [*encoder.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
