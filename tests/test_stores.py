"""Version log, score table and counts that the writing pass takes."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import clean
from tessera.sources.layers import LayerStore
from tessera.sources.scores import ScoreTable
from tessera.sources.versions import VersionLog, file_digests, partition_digests


def files_of(folder):
    return {str(p.relative_to(folder)): (p.stat().st_mtime_ns, p.stat().st_size) for p in folder.rglob("*.parquet")}


# -- versions ---------------------------------------------------------------------------------------


def test_file_digests(spark, tmp_path):
    for name, content in (("k=a/x.txt", b"hello\n"), ("k=a/y.txt", b""), ("k=b/z.txt", bytes(range(256)) * 99), ("k=b/skip.bin", b"-")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    got = {(r.k, r.path.rsplit("/", 1)[1]): (r.size, r.digest) for r in file_digests(spark, str(tmp_path), {"k": "string"}, "*.txt").collect()}
    want = {(p.parent.name[2:], p.name): (p.stat().st_size, hashlib.md5(p.read_bytes()).hexdigest()) for p in tmp_path.rglob("*.txt") if p.stat().st_size}
    assert got == want and len(got) == 2
    assert file_digests(spark, str(tmp_path / "absent")).count() == 0


def test_large_files_have_no_digest(spark, tmp_path, monkeypatch):
    from tessera.sources import versions

    monkeypatch.setattr(versions, "LARGEST", 10)
    (tmp_path / "a").write_bytes(b"x" * 10)
    (tmp_path / "b").write_bytes(b"x" * 11)
    assert {r.size: r.digest is None for r in file_digests(spark, str(tmp_path)).collect()} == {10: False, 11: True}


def test_version_log(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    df = spark.createDataFrame([(i, f"2024-01-0{1 + i % 3}") for i in range(9)], "x int, dt string").withColumn("dt", F.col("dt").cast("date"))
    store.write(df, "d", "raw")
    log = VersionLog(store)
    assert log.scan().count() == 0 and log.versions("d", "raw").count() == 0
    assert log.record("d", "raw") == 3 and log.record("d", "raw") == 0
    for value in (100, 200):
        store.write(spark.createDataFrame([(value,)], "x int"), "d", "raw", "2024-01-02")
        assert log.record("d", "raw") == 1
    store.write(spark.createDataFrame([(300,)], "x int"), "d", "raw", "2024-01-03")  # not recorded yet
    got = {(str(r.dt), r.generation): r.is_live for r in log.versions("d", "raw").collect()}
    assert got == {("2024-01-01", 1): True, ("2024-01-02", 1): False, ("2024-01-02", 2): False, ("2024-01-02", 3): True, ("2024-01-03", 1): False}
    newest = log.versions("d", "raw", "2024-01-02", limit=2).orderBy("generation").collect()
    assert [r.generation for r in newest] == [2, 3]
    assert newest[1].digest == partition_digests(store, "d", "raw").where("dt = '2024-01-02'").first().digest != newest[0].digest
    assert log.versions("other", "raw").count() == 0


# -- scores -----------------------------------------------------------------------------------------

SCORE = "cell string, bucket_no int, score double, model_version string"


def test_upsert_touches_only_the_buckets_of_its_keys(spark, tmp_path):
    table = ScoreTable(spark, str(tmp_path / "t"), ["cell", "bucket_no"], 16)
    old = [(f"c{i}", i % 3, float(i), "v1") for i in range(400)]
    assert len(table.upsert(spark.createDataFrame(old, SCORE))) == 16
    before = files_of(tmp_path / "t")
    new = [("c5", 2, -1.0, "v2"), ("new", 0, -2.0, "v2"), (None, 0, -3.0, "v2")]
    touched = table.upsert(spark.createDataFrame(new, SCORE))
    assert 1 <= len(touched) <= 3
    after = files_of(tmp_path / "t")
    same = {n for n in before if int(n.split("/")[0].split("=")[1]) not in touched}
    assert same and all(after[n] == before[n] for n in same)
    assert not any(n in after for n in set(before) - same)
    want = {(c, b): s for c, b, s, _ in old} | {(c, b): s for c, b, s, _ in new}
    assert {(r.cell, r.bucket_no): r.score for r in table.read().collect()} == want
    table.upsert(spark.createDataFrame([(None, 0, 7.0, "v3")], SCORE))  # a null key is a key
    assert {r.score for r in table.read().where("cell is null").collect()} == {7.0}


def test_stale_versions_go(spark, tmp_path):
    table = ScoreTable(spark, str(tmp_path / "t"), ["cell", "bucket_no"], 8)
    assert table.read() is None and table.drop_stale("v1") == [] and table.upsert(spark.createDataFrame([], SCORE)) == []
    rows = [(f"c{i}", 0, 1.0, "v2") for i in range(100)] + [("a", 0, 1.0, "v1"), ("b", 1, 1.0, None)]
    table.upsert(spark.createDataFrame(rows, SCORE))
    before = files_of(tmp_path / "t")
    touched = table.drop_stale("v2")
    assert len(touched) == 1 and table.read().count() == 101 and table.read().where("cell = 'a'").count() == 0
    after = files_of(tmp_path / "t")
    assert all(after[n] == before[n] for n in before if int(n.split("/")[0].split("=")[1]) not in touched)
    assert len(table.drop_stale("v9")) == 8 and {r.cell for r in table.read().collect()} == {"b"}  # buckets without rows are gone
    assert len([p for p in os.listdir(tmp_path / "t") if p.startswith("bucket=")]) == 1
    assert ScoreTable(spark, str(tmp_path / "t"), ["cell", "bucket_no"], 64).buckets == 8  # the table's own number counts


def test_repeated_new_rows(spark, tmp_path):
    table = ScoreTable(spark, str(tmp_path / "t"), ["cell", "bucket_no"], 4)
    table.upsert(spark.createDataFrame([("a", 0, 1.0, "v1"), ("a", 0, 2.0, "v3"), ("a", 0, 3.0, "v2")], SCORE), order=["model_version"])
    assert [r.score for r in table.read().collect()] == [2.0]


# -- counts in the writing pass ----------------------------------------------------------------------


def jobs(spark, work):
    spark.sparkContext.setJobGroup(group := os.urandom(4).hex(), "")
    try:
        result = work()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.fixture
def points(spark, tmp_path):
    rows = [(i, None if i % 10 == 0 else 42.3 if i % 3 else 99.0, -71.1) for i in range(1000)]
    path = str(tmp_path / "points")
    spark.createDataFrame(rows, "id int, lat double, long double").write.parquet(path)
    return spark.read.parquet(path)


def test_drops_are_counted_by_the_write(spark, tmp_path, points):
    reasons = clean.location_reasons()
    with clean.DropCounts() as counts:
        stay = clean.drop_rows(points, reasons)
    _, counted = jobs(spark, lambda: (stay.write.parquet(str(tmp_path / "a")), counts.counts()))
    _, plain = jobs(spark, lambda: clean.drop_rows(points, reasons).write.parquet(str(tmp_path / "b")))
    assert counted == plain == 1
    want = {r.drop_reason: r.rows for r in clean.ledger(clean.tag_drops(points, reasons)).collect()}
    assert counts.counts() == want and sum(want.values()) + stay.count() == 1000 and counts.rows() == [1000]
    assert {r.drop_reason: r.rows for r in counts.ledger(spark).collect()} == want


def test_no_counting_outside(spark, points):
    assert "CollectMetrics" not in clean.drop_rows(points, clean.location_reasons())._jdf.queryExecution().toString()


def test_write_counted(spark, tmp_path, points):
    store = LayerStore(spark, str(tmp_path / "store"))
    seen, n = jobs(spark, lambda: store.write_counted(points, "p", "raw", "2024-01-01", last=F.max("id"), missing=F.count_if(F.col("lat").isNull())))
    assert seen == {"rows": 1000, "last": 999, "missing": 100} and n == 1
    assert store.partition("p", "raw", "2024-01-01").count() == 1000 and store.pointer("p", "raw") == "2024-01-01"
    assert store.write_counted(points.limit(0), "p", "raw", "2024-01-02", last=F.max("id"))["rows"] == 0
