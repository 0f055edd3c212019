"""Queries against their SQL on tables with more or odder rows than the driver's small ones."""

import duckdb
import pytest

from scrivena.plans.oracles import ORACLES
from scrivena.plans.queries import QUERIES
from tests.oracle import rows_of, rows_of_sql


@pytest.fixture(scope="module")
def million(tmp_path_factory):
    """More than 999,999 events."""
    d = tmp_path_factory.mktemp("million")
    con = duckdb.connect()
    con.execute(f"copy (select i as event_id, i % 100 as user_id, ['click', 'view', 'error'][i % 3 + 1] as event_type, 1.0::double as value, timestamp '2024-01-01' as ts from range(1000030) t(i)) to '{d}/events.parquet'")
    con.execute(f"create view events as select * from '{d}/events.parquet'")
    return con, str(d)


def test_ids_of_seven_digits_are_those_of_the_sql(spark, million):
    con, d = million
    got = rows_of(QUERIES["fb_ids"](spark, d).where("event_id >= 999990"))
    assert got == rows_of_sql(con, f"select * from ({ORACLES['fb_ids']}) where event_id >= 999990")


def test_training_paths_of_seven_digits_are_those_of_the_sql(spark, million):
    con, d = million
    got = rows_of(QUERIES["fb_training_set"](spark, d).groupBy("crop_path", "text").count().where("crop_path like 'fallback/fb_1000%' or crop_path like 'crops/10000%'"))
    assert got == rows_of_sql(con, f"select crop_path, text, count(*) as count from ({ORACLES['fb_training_set']}) where crop_path like 'fallback/fb_1000%' or crop_path like 'crops/10000%' group by 1, 2")


def test_last_half_second_of_a_day(spark, tmp_path):
    con = duckdb.connect()
    times = ["2024-01-01 12:00:00", "2024-01-01 23:59:59.4", "2024-01-01 23:59:59.5", "2024-01-01 23:59:59.7", "2024-01-02 08:00:00", "2024-01-02 23:59:58.5", "2024-01-03 01:00:00", "1969-12-31 20:00:00", "1970-01-01 01:00:00"]
    con.execute(f"copy (select row_number() over () as event_id, 'a' as event_type, cast(unnest({times}) as timestamp) as ts) to '{tmp_path}/events.parquet'")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    assert rows_of(QUERIES["stream_rising_days"](spark, str(tmp_path))) == rows_of_sql(con, ORACLES["stream_rising_days"])


def test_schedules_meet_their_workers_by_a_shuffle(spark, tmp_path):
    from scrivena.sources import labels

    (tmp_path / "a.json").write_text('{"image_path": "x/a.png", "workers": ["w2", "w1", "w2"], "schedule": {"w1": {"1": "D"}, "w2": {"1": "N", "2": "D"}, "w9": {"3": "E"}}}')
    found = labels.schedules(spark, str(tmp_path))
    assert sorted((r.image, r.worker, r.worker_pos, r.day, r.gt_code) for r in found.collect()) == [("a", "w1", 1, "1", "D"), ("a", "w2", 0, "1", "N"), ("a", "w2", 0, "2", "D"), ("a", "w9", -1, "3", "E")]
    # A look through all workers for each worker costs the square of their number.
    assert "array_position" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_schedules_of_tokens_that_come_in_many_batches(spark, sf_dir):
    from tests.oracle import connect

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # most images lie in two batches or more
    try:
        found = QUERIES["tok_schedule"](spark, sf_dir)
        assert rows_of(found) == rows_of_sql(connect(sf_dir), ORACLES["tok_schedule"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    # Tokens are dealt by image before and after they are laid out, and nothing is dealt or joined after that.
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange ") <= 3


@pytest.fixture(scope="module")
def one_month(tmp_path_factory):
    """5,000 orders of 2,500 customers in two months."""
    d = tmp_path_factory.mktemp("month")
    con = duckdb.connect()
    con.execute(f"copy (select i as o_orderkey, i % 2500 as o_custkey, timestamp '2024-01-01' + to_days((i // 80)::int) as o_orderdate, (i % 5 + 1) || '-X' as o_orderpriority from range(5000) t(i)) to '{d}/orders.parquet'")
    con.execute(f"create view orders as select * from '{d}/orders.parquet'")
    from scrivena.plans.fixtures import SQL

    con.execute(f"create view schedule_gt as {SQL['schedule_gt']}")
    return con, str(d)


def test_no_row_or_record_holds_a_whole_schedule(spark, one_month, monkeypatch):
    from pyspark.sql import functions as F

    from scrivena.sources import sinks

    con, d = one_month
    longest = []

    def watched(write, column):
        def run(rows, *args):
            longest.append(rows.agg(F.max(F.length(column))).first()[0])
            return write(rows, *args)

        return run

    monkeypatch.setattr(sinks, "write_files", watched(sinks.write_files, "content"))
    monkeypatch.setattr(sinks, "write_parts", watched(sinks.write_parts, "piece"), raising=False)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # files and their parts go on from batch to batch
    try:
        found = QUERIES["src_schedules"](spark, d)
        assert rows_of(found) == rows_of_sql(con, ORACLES["src_schedules"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert longest and max(longest) < 200
    assert "multiLine" not in found._jdf.queryExecution().toString() and "Scan json" not in found._jdf.queryExecution().toString()


def test_large_and_odd_schedule_files_in_pieces(spark, tmp_path):
    import json

    from scrivena.sources import json_pieces, labels

    n = 60_000
    schedule = {f"w{n - i}": {"1": 'D"}{\\', "2": None} for i in range(n)}
    (tmp_path / "large.json").write_text(json.dumps({"schedule": schedule, "workers": [f"w{i}" for i in range(n)], "image_path": "x/a.png"}, indent=1))
    found = list(json_pieces.records(str(tmp_path / "large.json"), ("image_path", "format", "industry"), {"workers": "[", "schedule": "{"}))
    assert max(len(t) for _, t in found) < 200_000 and len(found) > 2 * n // json_pieces.ITEMS
    rows = labels.schedules(spark, str(tmp_path / "large.json"))
    assert rows.count() == 2 * n and rows.where("gt_code is null").count() == n and rows.select("image").distinct().count() == 1
    assert {(r.worker, r.worker_pos) for r in rows.select("worker", "worker_pos").collect()} == {(f"w{i}", i if i < n else -1) for i in range(1, n + 1)}
    odd = {
        '{"image_path":"x/a.png","workers":["w1",2,null],"schedule":{"w1":{"1":1.50,"2":[1, 2]},"2":{}}}': [("w1", 0, "1", "1.50"), ("w1", 0, "2", "[1, 2]")],
        '[{"image_path":"x/a.png","schedule":{"w1":{"1":"D"}}},{"image_path":"x/a.png","workers":[],"schedule":{"w1":{"1":"E"}}}]': [("w1", None, "1", "D"), ("w1", -1, "1", "E")],
        '{"image_path":"x/a.png","workers":["w1"],"workers":["w2","w1"],"schedule":{"w1":{"1":"D"}}}': [("w1", 1, "1", "D")],
        "{'image_path':'x/a.png','workers':['w1'],'schedule':{'w1':{'1':'D'}}}": [("w1", 0, "1", "D")],
        '{"image_path":"x/a.png","workers":["w1"],"schedule":{"w1":{"1":"D"},"w2":{"1" "D"}}}': [],
        '{"image_path":"x/a.png","workers":["w1"],"schedule":{"w1":{"1":"D"}}': [],
        "": [],
    }
    for i, (text, want) in enumerate(odd.items()):
        (tmp_path / f"o {i}%20.json").write_text(text)
        got = labels.schedules(spark, str(tmp_path / f"o {i}%20.json")).collect()
        assert sorted(((r.worker, r.worker_pos, r.day, r.gt_code) for r in got), key=str) == sorted(want, key=str)
