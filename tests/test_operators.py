import json

from pyspark.sql import functions as F

from scrivena.operators import catalogs, charset, ctc, dataset, detection, feedback, gates, images, recognition, registry, roster, shapes, synthetic, training
from scrivena.operators.ranks import ranked

BOX = "image_id string, idx int, x1 double, y1 double, x2 double, y2 double"


def boxes(spark, rows, truth=False):
    return spark.createDataFrame(rows, BOX + (", difficult boolean" if truth else ""))


def test_matching(spark):
    name = "paper_hospital_0001.jpg"
    pred = boxes(spark, [(name, 0, 0.0, 0.0, 10.0, 10.0), (name, 1, 20.0, 20.0, 30.0, 30.0)])
    gt = boxes(spark, [(name, 0, 0.0, 0.0, 10.0, 10.0, False), (name, 1, 40.0, 40.0, 50.0, 50.0, False)], True)
    r = detection.evaluate(pred, gt).first()
    assert (r.tp, r.fp, r.fn, r.f1) == (1, 1, 1, 0.5)
    twice = boxes(spark, [("a", 0, 0.0, 0.0, 10.0, 10.0), ("a", 1, 0.0, 0.0, 10.0, 10.0)])
    r = detection.evaluate(twice, boxes(spark, [("a", 0, 0.0, 0.0, 10.0, 10.0, False)], True)).first()
    assert (r.tp, r.fp, r.fn) == (1, 1, 0)
    hard = boxes(spark, [("a", 0, 0.0, 0.0, 10.0, 10.0, True)], True)
    r = detection.evaluate(boxes(spark, []), hard).first()
    assert (r.tp, r.fp, r.fn) == (0, 0, 0)
    r = detection.evaluate(twice.where("idx = 0"), hard).first()
    assert (r.tp, r.fn) == (1, 0)


def test_recognition(spark):
    rows = spark.createDataFrame([("crop/a.png", "D", "D"), ("crop/b.png", "OFF", "OEF"), ("crop/c.png", "09:00", "09:00"), ("crop/d.png", "###", "ABC"), ("crop/e.png", "", "x")], "image_path string, gt_text string, pred_text string")
    s = recognition.samples(rows)
    r = recognition.summary(s).first()
    assert (r.sample_count, r.correct, round(r.accuracy, 3), r.work_code_accuracy, r.date_exact_match) == (3, 2, 0.667, 0.5, 1.0)
    assert [tuple(c) for c in recognition.confusions(s).collect()] == [("F", "E", 1)]
    empty = recognition.samples(spark.createDataFrame([("crop/a.png", "OFF", "")], rows.schema))
    assert (empty.first().distance, empty.first().cer) == (3, 1.0)
    assert recognition.by_type(empty).count() == 4 and recognition.by_length(empty).count() == 5


def test_roster(spark):
    cells = [("1", 100, 0, 120, 20), ("2", 140, 0, 160, 20), ("Kim", 0, 40, 40, 60), ("D", 100, 40, 120, 60), ("E", 140, 40, 160, 60), ("Lee", 0, 80, 40, 100), ("N", 100, 80, 120, 100), ("OFF", 140, 80, 170, 100)]
    tokens = spark.createDataFrame([("img", i, *c) for i, c in enumerate(cells)], "image_id string, seq int, text string, x1 long, y1 long, x2 long, y2 long")
    got = {(r.worker, r.day): r.code for r in roster.parse(tokens).collect()}
    assert got == {("Kim", "1"): "D", ("Kim", "2"): "E", ("Lee", "1"): "N", ("Lee", "2"): "OFF"}
    gt = spark.createDataFrame([("img", w, d, c) for (w, d), c in got.items()], "image_id string, worker string, day string, gt_code string")
    meta = spark.createDataFrame([("img", True)], "image_id string, parse_success boolean")
    pred = gt.withColumnRenamed("gt_code", "pred_code")
    r = roster.compare(gt, pred, meta).first()
    assert (r.cell_accuracy, r.worker_schedule_accuracy, r.name_accuracy, r.code_distribution_error) == (1.0, 1.0, 1.0, 0.0)
    less = pred.withColumn("pred_code", F.when((F.col("worker") == "Kim") & (F.col("day") == "2"), "").otherwise(F.col("pred_code")))
    r = roster.compare(gt, less, meta).first()
    assert (r.cell_accuracy, r.worker_schedule_accuracy, r.error_count) == (0.75, 0.5, 1)
    assert [c.error_type for c in roster.cells(gt, less, meta).where("error_type is not null").collect()] == ["det_miss"]


GOOD = {
    "detection": {"metrics": {"f1": 0.9, "recall": 0.9, "precision": 0.9}},
    "recognition": {"metrics": {"cer": 0.02, "wer": 0.03, "accuracy": 0.95}, "domain_metrics": {"work_code_accuracy": 0.96, "date_exact_match": 0.95}, "by_type": {"single_char": {"cer": 0.01}}},
    "classifier": {"accuracy": 0.99, "false_positive_rate": 0.005},
    "e2e": {"metrics": {"cell_accuracy": 0.9, "worker_schedule_accuracy": 0.7, "name_accuracy": 0.85, "code_distribution_error": 0.02}, "parse_success_rate": 0.95},
    "deployment": {"speed": {"cpu_p50_seconds": 1.8}, "memory": {"model_loaded_gb": 1.4, "peak_inference_gb": 2.0}, "stability": {"exceptions_per_100": 0}},
}


def gate(spark, **change):
    runs = spark.createDataFrame([("r", k, json.dumps(change.get(k, v))) for k, v in GOOD.items()], "run string, section string, summary string")
    found = gates.gates(gates.criteria(runs))
    return gates.status(found).first(), {r.gate: (r.passed, r.skipped, r.failed_items) for r in found.collect()}


def test_gates(spark):
    assert gate(spark)[0].status == "PASS"
    status, by = gate(spark, detection={"metrics": {"f1": 0.7, "recall": 0.9, "precision": 0.9}})
    assert status.status == "FAIL" and by[1][2] == ["detection"] and by[2][1]
    assert gate(spark, deployment={"speed": {"cpu_p50_seconds": 3.5}, "memory": {"model_loaded_gb": 1, "peak_inference_gb": 1}, "stability": {"exceptions_per_100": 0}})[0].status == "CONDITIONAL_PASS"
    status, by = gate(spark, deployment={})
    assert status.status == "CONDITIONAL_PASS" and by[3][2] == ["deployment"]


def test_feedback(spark):
    got = spark.range(1).select(*(feedback.level(F.lit(x)) for x in (0.95, 0.80, 0.69))).first()
    assert tuple(got) == ("high", "mid", "low")
    rows = spark.createDataFrame([(1, "O", "0", True, 0.5, "imp", "2024-01-01"), (2, "a", "a", True, 0.9, "imp", "2024-01-02")], "event_id long, original_text string, corrected_text string, crop_saved boolean, confidence double, import_id string, ts string")
    s = feedback.statistics(rows, 1, ["0"]).first()
    assert (s.usable, s.ready, s.last_date) == (1, True, "2024-01-02")
    crops = spark.createDataFrame([("c/1.png",)], "path string")
    f = feedback.with_ids(rows).withColumn("crop_path", F.format_string("c/%d.png", "event_id"))
    assert feedback.training_set(f, crops, 1).count() == 1 and feedback.training_set(f, crops, 2).count() == 0
    t = spark.range(1).select(feedback.rollback_triggers(F.lit(0.07), F.lit(0.01), F.lit(10), F.lit(4.5), F.lit(False))).first()[0]
    assert len(t) == 4


def test_registry(spark):
    v = spark.createDataFrame([("1.0.0", "rollback_candidate")], "version string, status string")
    v = registry.upsert(v, spark.createDataFrame([("1.1.0", "rollback_candidate")], v.schema))
    v = registry.deploy(registry.deploy(v, "1.0.0"), "1.1.0")
    assert registry.active(v).first()[0] == "1.1.0"
    v = registry.rollback(v, "1.0.0")
    assert registry.active(v).first()[0] == "1.0.0"
    log = spark.createDataFrame([(i, "deploy_complete", "a", f"v{i}") for i in range(30)], "seq long, event string, `from` string, to string")
    assert registry.history(log).count() == 20 and registry.history(log, 0).count() == 30
    assert registry.active_from_log(log).first()[0] == "v29"


def test_ctc(spark):
    steps = [(0, 0, "A"), (0, 1, "A"), (0, 2, "B")]
    rows = [(s, t, v, 5.0 if "AB".find(c) == v else 0.0) for s, t, c in steps for v in range(5)]
    df = spark.createDataFrame(rows, "sample int, t int, v int, logit double")
    names = ["A", "B", "<unk>", "<pad>", "<blank>"]
    assert ctc.decode(df, names, 4).first().text == "AB"
    assert ctc.decode(df, names, 4, text_type="single_char").first().text == "A"
    assert ctc.decode(df, names, 4, "beam").first().text == "AB"


def test_dataset(spark):
    rows = [(i, f"f{i}.png", "synthetic" if i % 4 == 0 else "masked", f"k{i % 2}", i % 9 == 0, i % 5, 800, 900, f"h{i % 50}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, filename string, source string, format string, difficult boolean, detection_boxes int, width int, height int, file_md5 string")
    got = {r.doc_id: r for r in dataset.stratified_split(df).collect()}
    assert len(got) == 200
    held = [r for r in got.values() if r.split != "train"]
    assert held and all(r.source != "synthetic" for r in held) and not any(r.difficult for r in held if r.split == "test")
    assert dataset.duplicates(df).count() == 150
    issues = {r.issue for r in dataset.split_issues(dataset.stratified_split(df)).collect()}
    assert "train_image_count_below_minimum" in issues and not any(i.startswith("synthetic_found") for i in issues)
    assert dataset.quota_gaps(df, "format", {"k0": 150, "k9": 1}).count() == 2
    crops = spark.createDataFrame([("doc_1_0.png", "x"), ("doc_10_0.png", "y"), ("doc_1_x_2.png", "z")], "crop_name string, crop_text string")
    images_ = spark.createDataFrame([("doc_1.png",)], "filename string")
    assert dataset.label_prefix_join(images_, crops).first().crop_texts == ["x", "z"]
    assert ranked(df, "doc_id", 8).where("rank != doc_id + 1").count() == 0


def test_charset(spark):
    assert charset.vocabulary_size() == 11287 and charset.payroll_charset(spark).count() == 11284
    freq = charset.frequencies(spark.createDataFrame([("D낮",), ("낮☃",)], "text string"))
    assert {r.ch: r["count"] for r in freq.collect()} == {"D": 1, "낮": 2, "☃": 1}
    words = charset.dictionary(spark, freq).cache()
    assert words.orderBy(F.desc("idx")).first().token == "<blank>" and words.count() == 11288
    assert charset.dictionary_issues(words, freq).count() == 0
    assert charset.frequency_table(words, freq).where("count > 0").count() == 3


def test_training(spark):
    log = spark.createDataFrame([(1, i, float(i), 1001.0 if i == 3 else 1.0) for i in range(1, 13)], "run_id long, step long, loss_total double, grad_norm double")
    got = {r.step: r.issues for r in training.health(log).collect()}
    assert got[3] == ["grad_norm_spike"] and got[9] == [] and got[10] == ["loss_diverging"]
    points = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.6), (1, 3, 0.6)], "run_id long, step long, f1 double")
    assert [r.is_best for r in training.best(points, "f1").orderBy("step").collect()] == [True, True, False]
    assert [r.step for r in training.keep_last(points, 1).collect()] == [3]
    lat = registry.latency(spark.createDataFrame([(float(i),) for i in range(1, 6)], "v double"), "v").first()
    assert (lat.p50, lat.p95, lat.max) == (3.0, 4.0, 5.0)


def test_shapes(spark):
    r = spark.range(1).select(shapes.detection_resize(F.lit(777), F.lit(1111)).alias("d"), shapes.recognition_resize(F.lit(512), F.lit(128)).alias("r")).first()
    assert r.d.padded_w % 32 == 0 and r.d.padded_h % 32 == 0
    assert (r.r.resized_h, r.r.final_w) == (32, 320)
    inputs = spark.createDataFrame([(4, 3, 32, 128)], "b long, c long, h long, w long")
    assert shapes.recognition_maps(inputs).first().output == [4, 32, 11287]
    assert shapes.classifier_maps(inputs).count() == 1 and shapes.detection_maps(inputs).count() == 4


def test_synthetic(spark):
    rows = synthetic.augment_labels(spark, 50, "food", ["a", "b", "c"]).collect()
    assert [r.source_image for r in rows[:4]] == ["a", "b", "c", "a"]
    cost = {n: s for n, _, s in synthetic.AUGMENTATIONS}
    assert all(sum(cost[a] for a in r.augmentations) <= 0.65 + 1e-9 for r in rows)
    assert synthetic.render_labels(spark, 5, "food").first().filename == "synth_render_food_00001.png"
    assert catalogs.items(spark, "formats").count() == 5 and catalogs.grid(spark, a=[1, 2], b=[3]).count() == 2


def test_images(spark):
    import numpy as np

    x = np.arange(2 * 3 * 3, dtype=np.uint8).reshape(2, 3, 3)
    df = spark.createDataFrame([(images.struct_of(x),)], f"image {images.IMAGE}")
    turn = images.array_of(df.select(images.rotated(90)(F.col("image")).alias("i")).first().i.asDict())
    assert (turn == np.rot90(x, -1)).all()
    flip = images.array_of(df.select(images.flipped()(F.col("image")).alias("i")).first().i.asDict())
    assert (flip == x[:, ::-1]).all()
    assert df.select(images.variance()(F.col("image"))).first()[0] > 0
    assert len(df.select(images.normalized()(F.col("image"))).first()[0]) == 18
    assert images.padded_batch([x, x[:1]]).shape == (2, 3, 2, 3) and images.box_targets(16, 16, [[0, 0, 8, 8]]).max() > 0


def image_meta_dir(spark, path, ids):
    spark.createDataFrame([(i,) for i in ids for _ in range(2)], "l_orderkey long").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_quota_gaps_count_the_whole_table(spark, tmp_path):
    from scrivena.plans.queries import QUERIES

    ids = [*range(0, 1500, 5), *range(2001, 2501, 5), *range(3003, 3018, 5), *range(2, 252, 5)]
    gaps = {r.key: (r.actual, r.missing) for r in QUERIES["ds_quota_gaps"](spark, image_meta_dir(spark, tmp_path, ids)).collect()}
    assert gaps == {"screen": (50, 100), "excel": (3, 97), "handwrite": (0, 50)}


def test_synth_plan_counts_the_whole_table(spark, tmp_path):
    from scrivena.plans.queries import QUERIES

    ids = [*range(0, 600, 6), *range(6001, 6295, 6), *range(302, 602, 6), *range(9003, 9009, 6)]
    plan = {r.industry: (r.real_count, r.recommended_render, r.recommended_aug) for r in QUERIES["synth_plan"](spark, image_meta_dir(spark, tmp_path, ids)).collect()}
    assert plan == {"hospital": (100, 0, 200), "convenience": (49, 25, 25), "factory": (50, 0, 150), "office": (1, 25, 25)}
    none = dataset.supplements(spark.createDataFrame([("food", 0)], "industry string, real_count long")).first()
    assert (none.recommended_render, none.recommended_aug) == (80, 0)
