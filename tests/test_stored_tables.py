"""Headers without a scan, the order of rows over many files, and versions of a table."""

import csv
import gzip
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachscope import schema as S
from breachscope.operators import cleaning as L
from breachscope.sources import csv_format, events, replace
from breachscope.sources import incidents as I
from tests.fixtures import incidents, sample_rows

NAMES = ["number", "sys_updated_at", *S.EVENT_COUNTERS, "category"]


def _log_file(path, rows, names=NAMES, opener=open):
    with opener(path, "wt", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(names)
        for number, category in rows:
            row = {"number": number, "category": category, "sys_updated_at": "1/2/2016 10:00"}
            writer.writerow([row.get(n, "1") for n in names])


def test_headers_cost_the_same_for_long_files(spark, tmp_path, monkeypatch):
    counted = []
    jobs = spark.sparkContext.statusTracker()
    for size in (200, 200_000):
        folder = tmp_path / str(size)
        folder.mkdir()
        for i in range(3):
            _log_file(folder / f"{i}.csv", [(f"I{j}", "x" * 40) for j in range(size)])
        statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics
        before = sum(s.getBytesRead() for s in statistics())
        spark.sparkContext.setJobGroup(f"headers {size}", "")
        assert list(csv_format.file_headers(spark, str(folder))) == [tuple(NAMES)]
        assert len(jobs.getJobIdsForGroup(f"headers {size}")) == 0
        counted.append(sum(s.getBytesRead() for s in statistics()) - before)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counted[1] < 3 * 4 * csv_format.HEAD_BYTES
    monkeypatch.setattr(csv_format, "HEAD_BYTES", 16)  # a header longer than a block
    assert csv_format.read_header(spark, str(tmp_path / "200" / "0.csv")) == tuple(NAMES)


def test_headers_of_odd_files(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbfa,\"b\r\nc\"\r\n1,2\r\n")
    (tmp_path / "blank.csv").write_bytes(b"\n \na,b")
    (tmp_path / "empty.csv").write_bytes(b"")
    with gzip.open(tmp_path / "z.csv.gz", "wb") as file:
        file.write(b"x,y\n" + b"1,2\n" * 50_000)
    read = {f: csv_format.read_header(spark, str(tmp_path / f)) for f in ("bom.csv", "blank.csv", "empty.csv", "z.csv.gz")}
    assert read == {"bom.csv": ("a", "b\r\nc"), "blank.csv": ("a", "b"), "empty.csv": None, "z.csv.gz": ("x", "y")}
    with pytest.raises(ValueError, match="no CSV header"):
        csv_format.file_headers(spark, str(tmp_path / "empty.csv"))


@pytest.mark.parametrize("most", [100_000, 1])
def test_the_order_of_rows_follows_the_names_of_files(spark, tmp_path, monkeypatch, most):
    """With names that are encoded in paths, and columns in another order in one file."""
    monkeypatch.setattr(events, "NUMBERED_FILES", most)
    names = ["a b+c&d.csv", "b%20.csv", "c é.csv", "d.csv"]
    for i, name in enumerate(names):
        _log_file(tmp_path / name, [("I1", f"c{i}"), (f"J{i}", "x")], NAMES[::-1] if i == 2 else NAMES)
    log = events.read_event_log(spark, str(tmp_path))
    kind = log.schema[L.ROW_ORDER].dataType["file"].dataType
    assert isinstance(kind, T.IntegerType if most > 1 else T.StringType)
    assert [r["category"] for r in log.where("number = 'I1'").orderBy(L.ROW_ORDER).collect()] == ["c0", "c1", "c2", "c3"]
    if most > 1:
        assert {r["f"] for r in log.select(F.col(L.ROW_ORDER)["file"].alias("f")).collect()} == {0, 1, 2, 3}
    last = L.collapse_events(log, ["category"]).where("number = 'I1'").first()
    assert last["category"] == "c3"  # equal times follow the order of the log


@pytest.fixture
def frames(spark):
    return [incidents(spark, sample_rows(n)) for n in (20, 30, 40)]


def test_a_reader_from_before_the_swap_finishes(spark, frames, tmp_path):
    path = str(tmp_path / "t")
    I.write_incidents(frames[0], path, partition_by=("opened_year",))
    opened = I.read_incidents(spark, path)
    I.write_incidents(frames[1], path)
    assert opened.count() == 20 and I.read_incidents(spark, path).count() == 30
    I.write_incidents(frames[2], path)
    assert I.read_incidents(spark, path).count() == 40
    assert len(list((tmp_path / "t" / "_versions").iterdir())) == replace.KEPT_VERSIONS
    with pytest.raises(Exception, match="(?i)exist"):
        opened.count()  # two versions on, its files are gone


def test_readers_never_find_a_gap(spark, frames, tmp_path):
    path = str(tmp_path / "t")
    I.write_incidents(frames[0], path)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(I.read_incidents(spark, path).count())
            except Exception as error:
                seen.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for frame in frames:
        I.write_incidents(frame, path)
    stop.set()
    reader.join()
    assert seen and set(seen) <= {20, 30, 40}


def test_a_killed_load_leaves_the_old_version(spark, frames, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    I.write_incidents(frames[0], path)

    def killed(*_):
        raise KeyboardInterrupt  # not an error that the load could tidy up after

    with monkeypatch.context() as patch:
        patch.setattr(I, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            I.write_incidents(frames[1], path)
    assert I.read_incidents(spark, path).count() == 20
    versions = tmp_path / "t" / "_versions"
    assert len(list(versions.iterdir())) == 2
    replace.sweep(spark, path)
    assert len(list(versions.iterdir())) == 1 and I.read_incidents(spark, path).count() == 20


def test_a_plain_folder_becomes_versioned(spark, frames, tmp_path):
    path = str(tmp_path / "t")
    frames[0].write.parquet(path)
    opened = I.read_incidents(spark, path)
    I.write_incidents(frames[1], path)
    assert opened.count() == 20 and I.read_incidents(spark, path).count() == 30
    I.write_incidents(frames[2], path)
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if not p.name.startswith(".")) == ["_markers", "_versions"]
