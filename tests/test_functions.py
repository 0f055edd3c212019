import random

from pyspark.sql import functions as F

from scrivena.functions import geometry as g
from scrivena.functions import scalars as sc
from scrivena.functions import text as t


def one(spark, *cols):
    r = spark.range(1).select(*cols).first()
    return r[0] if len(cols) == 1 else tuple(r)


def box(*v):
    return g.box(*(F.lit(x) for x in v))


def test_iou(spark):
    assert one(spark, g.iou(box(0, 0, 10, 10), box(0, 0, 10, 10))) == 1.0
    assert one(spark, g.iou(box(0, 0, 10, 10), box(20, 20, 30, 30))) == 0.0
    assert one(spark, g.iou(box(10, 10, 0, 0), box(0, 0, 10, 10))) == 1.0
    assert one(spark, g.iou_raw(box(10, 10, 0, 0), box(0, 0, 10, 10))) == 0.0


def test_boxes(spark):
    assert tuple(one(spark, g.restore(box(100, 50, 200, 80), 960, 736, 0, 0, 1200, 900))) == (125, 61, 250, 98)
    assert tuple(one(spark, g.clip(box(-1, 5, 300, 2), 200, 100))) == (0, 2, 200, 5)
    assert tuple(one(spark, g.flip(box(10, 10, 50, 40), 200))) == (150, 10, 190, 40)
    assert one(spark, g.scaled(box(10, 10, 50, 40), 0.5))["x1"] == 5
    both = F.array(box(0, 0, 10, 10), box(5, 5, 5, 7))
    assert [tuple(b) for b in one(spark, g.clip_all(both, 20, 20))] == [(0, 0, 10, 10)]
    assert one(spark, g.intersection(box(0, 0, 1, 1), box(2, 2, 3, 3))) is None
    assert one(spark, g.polygon(box(0, 0, 1, 2))) == [[0, 0], [1, 0], [1, 2], [0, 2]]
    assert tuple(one(spark, g.affine(box(0, 0, 10, 10), [[1, 0, 5], [0, 1, 2]], 100, 100))) == (5, 2, 15, 12)
    assert tuple(one(spark, g.perspective(box(0, 0, 10, 10), [[1, 0, 0], [0, 1, 0], [0, 0, 1]], 100, 100))) == (0, 0, 10, 10)


def test_scalars(spark):
    assert one(spark, sc.safe_div(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, sc.half_even(F.lit(2.5)), sc.half_even(F.lit(3.5))) == (2, 4)
    assert one(spark, sc.parse_bool(F.lit(" Off ")), sc.parse_bool(F.lit("yes"))) == (False, True)
    assert one(spark, sc.argmax(F.lit([1.0, 3.0, 3.0]))) == 1
    assert abs(sum(one(spark, sc.softmax(F.lit([1000.0, 1000.0, 0.0])))) - 1) < 1e-12
    assert one(spark, sc.metric(F.lit('{"a": {"b": 2}}'), "a", "b"), sc.metric(F.lit("{}"), "x", default=9.0)) == (2.0, 9.0)
    assert one(spark, sc.uniform(1, F.lit("k")) == sc.uniform(1, F.lit("k")))
    assert sc.scale_range(0.0, 2.0, 0.5) == (0.5, 1.5)


def test_texts(spark):
    kind = lambda s, p="": t.text_type(F.lit(s), F.lit(p))
    assert one(spark, kind("D"), kind("09:00"), kind("any", "handwrite_sample.png"), kind("OFF")) == ("single_char", "date", "handwrite", "normal")
    assert one(spark, t.edit_distance(F.lit("냥"), F.lit("낮"))) == 1
    assert one(spark, t.cell_id(F.lit("imp_1"), F.lit(2)), t.cell_id(F.lit("imp"), F.lit(1), F.lit(3), F.lit(7))) == ("imp_1_cell002", "imp_row03_col07")
    assert one(spark, t.valid_filename(F.lit("Paper_hospital_0001.JPG")), t.valid_filename(F.lit("x.png"))) == (True, False)
    parts = one(spark, t.filename_parts(F.lit("a/synth_render_office_00001.png")))
    assert tuple(parts) == ("render", "office")
    assert one(spark, t.image_filename(F.lit("scan"), F.lit("food"), F.lit(7), F.lit("png"))) == "scan_food_0007.png"
    assert one(spark, t.resolved(F.lit("/a/"), F.lit("b"))) == "/a/b"


def apply(pred, ops):
    """The text that the operations lead to, for those of one pass from left to right."""
    out, i = [], 0
    for kind, gt, p in ops:
        while kind != "insert" and i < len(pred) and pred[i] != p:
            out.append(pred[i])
            i += 1
        if kind != "insert":
            i += 1
        if kind != "delete":
            out.append(gt)
    return out


def test_edit_ops(spark):
    rng = random.Random(1)
    rows = [("".join(rng.choice("abc") for _ in range(rng.randint(0, 6))), "".join(rng.choice("abc") for _ in range(rng.randint(0, 6)))) for _ in range(200)] + [("", ""), (None, "a")]
    df = spark.createDataFrame(rows, "p string, g string")
    for r in df.select("p", "g", t.edit_ops(F.col("p"), F.col("g")).alias("ops"), F.levenshtein("p", "g").alias("d")).collect():
        if r.p is None:
            assert r.ops is None
        else:
            assert len(r.ops) == r.d
            grow = sum(o.op == "insert" for o in r.ops) - sum(o.op == "delete" for o in r.ops)
            assert len(r.g) - len(r.p) == grow
    assert [tuple(o) for o in one(spark, t.edit_ops(F.lit("OEF"), F.lit("OFF")))] == [("substitute", "F", "E")]
