import json

from pyspark.sql import functions as F

from scrivena.sources import labels, sinks
from scrivena.streaming import streams


def test_detection_labels(spark, tmp_path):
    p = tmp_path / "det_gt.txt"
    one = [{"transcription": "D", "points": [[12, 34], [56, 34], [56, 60], [12, 60]], "difficult": False}]
    p.write_text("img/a.jpg\t" + json.dumps(one) + "\n\nno tab here\nimg/a.jpg\t" + json.dumps(one + one) + "\n", encoding="utf-8")
    rows = labels.detection_labels(spark, str(p))
    assert rows.count() == 2
    assert labels.last_by_name(rows).select(F.size("polygons")).first()[0] == 2
    assert tuple(labels.boxes(rows, whole=True).select("x1", "y1", "x2", "y2").first()) == (12, 34, 56, 60)


def test_recognition_labels(spark, tmp_path):
    p = tmp_path / "rec_gt.txt"
    p.write_text("crop/a.png D\ncrop/b.png 낮 밤\nnospace\n", encoding="utf-8")
    assert [r.text for r in labels.recognition_labels(spark, str(p)).orderBy("line").collect()] == ["D", "낮 밤"]
    p.write_text("<a>\nb\n<blank>\n", encoding="utf-8")
    assert [(r.idx, r.token) for r in labels.dictionary(spark, str(p)).orderBy("idx").collect()] == [(0, "<a>"), (1, "b"), (2, "<blank>")]


def test_schedules_and_tokens(spark, tmp_path):
    p = tmp_path / "gt.json"
    p.write_text(json.dumps({"image_path": "x/a.png", "workers": ["Kim"], "schedule": {"Kim": {"1": "D", "2": "E"}}}))
    assert {(r.image, r.worker, r.worker_pos, r.day, r.gt_code) for r in labels.schedules(spark, str(p)).collect()} == {("a", "Kim", 0, "1", "D"), ("a", "Kim", 0, "2", "E")}
    token = {"text": "D", "bbox": [0, 0, 1, 1]}
    for i, body in enumerate(({"a": [token, {"text": None}]}, [{"image": "a", "tokens": [token]}])):
        q = tmp_path / f"t{i}.json"
        q.write_text(json.dumps(body))
        assert [(r.image, r.text, r.score) for r in labels.tokens(spark, str(q)).collect()] == [("a", "D", 1.0)]


def test_logs(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", 1)], "x string, extra int")
    sinks.append_log(rows, ["x", "y"], path)
    sinks.append_log(rows, ["x", "y"], path)
    got = labels.csv_log(spark, path, ["x", "y"]).collect()
    assert [(r.x, r.y) for r in got] == [("a", None), ("a", None)]
    events = spark.createDataFrame([("deploy", None)], "event string, reason string")
    sinks.append_events(events, str(tmp_path / "e"))
    assert spark.read.text(str(tmp_path / "e")).first()[0] == '{"event":"deploy"}'
    text = sinks.evaluation_report(spark.createDataFrame([(0.5,)], "f1 double"), "Report", worst=rows)
    assert "f1: 0.5000" in text and "| a | 1 |" in text
    line = spark.range(1).select(sinks.recognition_line(F.lit("a.png"), F.lit("D"))).first()[0]
    assert line == "a.png D"


def test_health_stream_equals_batch(spark, tmp_path):
    from scrivena.operators import training

    schema = "run_id long, step long, loss_total double, grad_norm double"
    rows = spark.createDataFrame([(r, i, float(i if r else -i), 1001.0 if i == 3 else 1.0) for r in (0, 1) for i in range(1, 13)], schema)
    src = str(tmp_path / "in")
    rows.repartition(2).write.json(src)
    q = streams.health(streams.read_log(spark, src, schema)).writeStream.format("memory").queryName("health").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = training.health(rows).select("run_id", "step", F.explode("issues").alias("issue"))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(spark.sql("select run_id, step, issue from health")) == key(batch)


def test_feedback_stream(spark, tmp_path):
    schema = "ts timestamp, confidence double, event_type string"
    rows = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,cast(id as int)) as ts, id % 10 / 10D as confidence, if(id % 3 = 0, 'error', 'x') as event_type from range(120)")
    rows.write.json(str(tmp_path / "in"))
    stream = streams.feedback_levels(streams.read_log(spark, str(tmp_path / "in"), schema))
    q = stream.writeStream.format("memory").queryName("levels").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(spark.sql("select * from levels")) == key(streams.feedback_levels(rows)) != []
    assert streams.error_rates(rows).agg(F.sum("errors")).first()[0] == 40


def test_reports_are_short(spark):
    import pytest

    one = spark.createDataFrame([(0.5,)], "f1 double")
    with pytest.raises(ValueError, match="at most"):
        sinks.evaluation_report(one, "Report", rows=spark.range(sinks.REPORTED + 1))
    assert "| 999 |" in sinks.evaluation_report(one, "Report", rows=spark.range(sinks.REPORTED))


def test_health_stream_of_many_runs_in_small_batches(spark, tmp_path):
    from scrivena.operators import training

    schema = "run_id long, step long, loss_total double, grad_norm double"
    rows = spark.createDataFrame([(r, i, float("nan") if (r + i) % 13 == 0 else float((r + 1) * i % 17), 1000.0 + r % 2 * i) for r in range(40) for i in range(1, 13)], schema)
    src, before = str(tmp_path / "in"), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # a run's steps come in several pieces
    try:
        for early in (True, False):
            rows.where((F.col("step") <= 5) == early).orderBy(F.desc("step")).coalesce(1).write.mode("append").json(src, ignoreNullFields=False)
            stream = streams.health(streams.read_log(spark, src, schema), rising=4).writeStream.option("checkpointLocation", str(tmp_path / "state"))
            q = stream.format("parquet").option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
            q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    batch = training.health(rows, rising=4).select("run_id", "step", F.explode("issues").alias("issue"))
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(spark.read.parquet(str(tmp_path / "out")).select("run_id", "step", "issue")) == key(batch) != []
