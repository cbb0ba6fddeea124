"""Stream queries over tables that are folders of files, against their SQL."""

import duckdb
import pytest

from check_oracle import rows_of
from tests.conftest import SF
from tessera.plans import load_queries


def against_sql(spark, folder, name, files):
    queries, oracles = load_queries()
    df = queries[name](spark, str(folder))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    for table, path in files.items():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    cur = con.execute(oracles[name])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert got == want and len(want[1]) > 0


@pytest.mark.parametrize("parts", [0, 3])
def test_sessions_of_a_table_in_one_or_many_files(spark, tmp_path, parts):
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    path = tmp_path / "conversations.parquet"
    if parts:
        rows.repartition(parts).write.parquet(str(path))
    else:
        rows.coalesce(1).write.parquet(str(tmp_path / "one"))
        next((tmp_path / "one").glob("*.parquet")).rename(path)
    against_sql(spark, tmp_path, "stm7_session_history", {"conversations": f"{path}/*.parquet" if parts else path})


@pytest.mark.parametrize("name", ["stm5_sustained_breach", "stm5_breach_by_type", "stm5_threshold_alerts"])
def test_alerts_of_events_in_many_files(spark, tmp_path, name):
    """Every file holds rows of all times, as tables of several files do."""
    path = tmp_path / "events.parquet"
    spark.read.parquet("/root/testdata/sf0.01/events.parquet").repartition(6).write.parquet(str(path))
    against_sql(spark, tmp_path, name, {"events": f"{path}/*.parquet"})


def test_alerts_of_no_events(spark, tmp_path):
    spark.read.parquet(f"{SF}/events.parquet").limit(0).write.parquet(str(tmp_path / "events.parquet"))
    assert load_queries()[0]["stm5_breach_by_type"](spark, str(tmp_path)).count() == 0


def newest_events(spark, tmp_path):
    """Three and a half hours above all limits up to the newest row, so that windows are open when the stream ends."""
    rows = [(i, f"2024-01-01 {i // 60:02d}:{i % 60:02d}:30", i, "error", 30.0, "{}") for i in range(210)]
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    path = tmp_path / "events.parquet"
    events.select(*[events[f.name].cast(f.dataType) for f in schema]).write.parquet(str(path))
    return {"events": f"{path}/*.parquet"}


def test_sustained_breaches_of_the_newest_hours(spark, tmp_path):
    against_sql(spark, tmp_path, "stm5_sustained_breach", newest_events(spark, tmp_path))
    got = load_queries()[0]["stm5_sustained_breach"](spark, str(tmp_path)).collect()
    assert sorted(r.window_start.hour for r in got) == [2, 3]


def test_threshold_alerts_of_the_newest_day(spark, tmp_path):
    against_sql(spark, tmp_path, "stm5_threshold_alerts", newest_events(spark, tmp_path))
