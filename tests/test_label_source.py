"""Label files as data sources: byte ranges, pushed filters, broken lines; listings and prerequisites."""

import json
import random

import pytest
from pyspark.sql import functions as F

from scrivena.operators import prerequisites
from scrivena.sources import label_source, sinks
from scrivena.sources.label_source import LineReader, _lines


@pytest.fixture(scope="module")
def label_files(tmp_path_factory):
    root = tmp_path_factory.mktemp("labels")
    rng = random.Random(1)
    rows = {}
    for f in ("a.txt", "b.txt", "_hidden.txt"):
        with open(root / f, "w", newline="", encoding="utf-8") as out:
            for i in range(300):
                name = f"img/{f[0]}_{i:03d}.jpg"
                p = [{"transcription": rng.choice(["D", "낮", ""]), "points": [[1, 2.5], [3, 2], [3, 4], [1, 4]], "difficult": i % 2 == 0}] * rng.randrange(4)
                out.write(f"{name}\t{json.dumps(p, ensure_ascii=False)}{rng.choice(['\n', '\r\n', '\n\n'])}")
                rows[name] = len(p)
            out.write("no separator\nimg/broken.jpg\t{oops")
    return str(root), {k: v for k, v in rows.items() if "_" in k and not k.startswith("img/_")}


def load(spark, path, **options):
    return label_source.register(spark).read.format("detection_labels").options(**options).load(path)


@pytest.mark.parametrize("size", [7, 100, 4096, 1 << 26])
def test_every_line_is_read_once(spark, label_files, size):
    path, want = label_files
    got = load(spark, path, rangeBytes=size).select("name", "image_path", F.size("polygons").alias("n")).collect() if size > 7 else load(spark, f"{path}/a.txt", rangeBytes=997).select("name", "image_path", F.size("polygons").alias("n")).collect()
    names = [r.image_path for r in got if r.name != "broken.jpg"]
    assert len(names) == len(set(names))
    assert {r.image_path: r.n for r in got if r.name != "broken.jpg"} == (want if size > 7 else {k: v for k, v in want.items() if "/a_" in k})


@pytest.mark.parametrize("body", [b"", b"\n", b"a", b"a\n", b"\n\na\nbb\n\nccc", b"a\r\nb"])
def test_ranges_of_any_size(tmp_path, body):
    p = tmp_path / "f"
    p.write_bytes(body)
    whole = [(at, line) for at, line in _lines(str(p), 0, len(body)) if line]
    assert [line for _, line in whole] == [x.rstrip(b"\r") for x in body.split(b"\n") if x.strip()]
    for step in range(1, len(body) + 2):
        for piece in (1, 2, 1 << 20):
            got = [x for a in range(0, len(body), step) for x in _lines(str(p), a, min(a + step, len(body)), piece) if x[1]]
            assert got == whole, (step, piece)


def test_filters_are_pushed(spark, label_files):
    path, want = label_files
    rows = load(spark, path).where("name >= 'b_' and name like 'b%' and image_path in ('img/b_007.jpg', 'img/b_008.jpg') and size(polygons) >= 0")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Filter (size(polygons" in plan and "name#" not in plan.split("BatchScan")[0].split("Filter")[1].split("\n")[0]
    assert {r.image_path: len(r.polygons) for r in rows.collect()} == {k: want[k] for k in ("img/b_007.jpg", "img/b_008.jpg")}
    assert load(spark, path).where("name = 'x' or offset = 0").count() == 2  # cannot be pushed


def test_filters_drop_files_and_lines(label_files):
    from pyspark.sql import datasource as ds

    path, _ = label_files
    reader = label_source.DetectionLabels({"path": path}).reader(None)
    assert isinstance(reader, LineReader)
    left = list(reader.pushFilters([ds.EqualTo(("file",), f"{path}/a.txt"), ds.StringStartsWith(("name",), "a_00"), ds.EqualTo(("polygons",), 1), ds.EqualTo(("name", "x"), 1)]))
    assert [f.attribute for f in left] == [("polygons",), ("name", "x")]
    parts = reader.partitions()
    assert [p.path for p in parts] == [f"{path}/a.txt"]
    assert [r["name"] for r in reader._rows(parts[0])] == [f"a_00{i}.jpg" for i in range(10)]


def test_broken_lines(spark, label_files, tmp_path):
    path, _ = label_files
    assert load(spark, path).where("name = 'broken.jpg'").select("polygons").distinct().collect()[0][0] is None
    with pytest.raises(Exception, match="no separator"):
        load(spark, path, strict="true").count()
    with pytest.raises(Exception, match="nothing"):
        load(spark, str(tmp_path / "nothing")).count()
    (tmp_path / "empty.txt").write_text("")
    assert load(spark, str(tmp_path / "empty.txt")).count() == 0


def test_recognition_and_events(spark, tmp_path):
    (tmp_path / "rec.txt").write_text("crop/a.png 낮 밤\nnospace\n crop/b.png\ncrop/c.png \n", encoding="utf-8")
    rows = label_source.register(spark).read.format("recognition_labels").load(str(tmp_path / "rec.txt"))
    assert [(r.crop_path, r.name, r.text) for r in rows.orderBy("offset").collect()] == [("crop/a.png", "a.png", "낮 밤"), ("", "", "crop/b.png"), ("crop/c.png", "c.png", "")]
    (tmp_path / "log.json").write_text('{"event":"x","n":3}\n[1]\nbroken\n{"n":null}\n', encoding="utf-8")
    log = spark.read.format("json_events").schema("offset long, event string, n long").load(str(tmp_path / "log.json"))
    assert [(r.event, r.n) for r in log.orderBy("offset").collect()] == [("x", 3), (None, None), (None, None), (None, None)]


def test_prerequisites(spark, tmp_path):
    files = spark.createDataFrame([(f"data/masked/{i}.jpg", b"x") for i in range(600)] + [(f"data/synthetic/a/{i}.png", b"") for i in range(400)] + [(f"data/synthetic/labels/{i}.json", b"") for i in range(400)] + [("data/labels/crop/1.png", b""), ("data/labels/det_gt.txt", b""), ("data/labels/rec_gt.txt", b""), ("data/meta/annotation_log.csv", b"")], "name string, content binary")
    assert sinks.write_files(files.repartition(3), str(tmp_path)) == 1404
    found = prerequisites.listing(spark, str(tmp_path))
    assert found.agg(F.count("*"), F.sum("length")).first() == (1404, 600)  # empty files are there too
    log = lambda *status: spark.createDataFrame([(s,) for s in status], "status string")
    unmet = lambda f, lg: [(r.issue, r.found) for r in prerequisites.unmet(prerequisites.counts(f, lg)).collect()]
    assert unmet(found, log("done")) == []
    assert unmet(found, log("done", "rejected", None)) == [("annotation_log_contains_rejected", 1)]
    names = [i for i, _ in unmet(found.where("false"), log("rejected"))]
    assert names == ["masked_count_below_600", "synthetic_count_below_400", "det_gt_missing", "rec_gt_missing", "crop_images_missing", "annotation_log_missing"]
