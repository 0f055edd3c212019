"""Queries over images: augmentation of boxes and crops, and measurements on pixel tables made from the embeddings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivena.functions import text as t
from scrivena.operators import augment, pixels, raster
from scrivena.plans.fixtures import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Size of an image made from a vector, the distance and width of its lines, and the angles that it may be skewed by.
WIDE, HIGH, EVERY, THICK, LOW, TOP, STEP = 128, 48, 12, 4, -12.0, 12.0, 0.5
SKEWS = pixels.angles(-10.0, 10.0, STEP)


def query(sql: str) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _draw(key: str, name: str) -> str:
    return f"(cast('0x' || substr(md5('42|' || {key} || '|{name}'), 1, 8) as bigint) / 4294967296.0::double)"


def _range(u: str, s: augment.Step) -> str:
    return f"({float(s.low)}::double + {u} * {float(s.high - s.low)}::double)"


def _clamped(value: str, side: str) -> str:
    return f"cast(trunc(greatest(0, least({value}, cast({side} as double) - 1))) as bigint)"


def _corners(x: str, y: str) -> str:
    """The bounding box of four corners; x and y are SQL of a corner's image, with {x} and {y} for the corner."""
    at = [(a, b) for a in ("x1", "x2") for b in ("y1", "y2")]
    xs, ys = (", ".join(f.replace("{x}", a).replace("{y}", b) for a, b in at) for f in (x, y))
    return f"{_clamped(f'least({xs})', 'w')} as x1, {_clamped(f'least({ys})', 'h')} as y1, {_clamped(f'greatest({xs})', 'w')} as x2, {_clamped(f'greatest({ys})', 'h')} as y2"


def _chain_sql() -> str:
    """The steps of detection boxes, a table for each; a step's rows are those that it changes and the others."""
    s = {x.name: x for x in augment.DETECTION_GEOMETRY}
    u = lambda n: _draw("image_id", n)
    draws = ", ".join(f"{u(n)} < {x.chance} as on_{n}, {_range(u(f'{n}.value'), x)} as {n}" for n, x in s.items())
    points = ", ".join(f"{f'(w - 1) * {int(i in (1, 2))}'} + w * {_range(u(f'perspective.x{i}'), s['perspective'])} as px{i}, {f'(h - 1) * {int(i in (2, 3))}'} + h * {_range(u(f'perspective.y{i}'), s['perspective'])} as py{i}" for i in range(4))
    turn = _corners("({x} * c + {y} * s + ((1 - c) * (w / 2.0::double) - s * (h / 2.0::double)))", "({x} * -s + {y} * c + (s * (w / 2.0::double) + (1 - c) * (h / 2.0::double)))")
    u_, v_ = "({x} / (w - 1))", "({y} / (h - 1))"
    d = f"(p * {u_} + q * {v_} + 1)"
    warp = _corners(*(f"((({k}1 - {k}0 + p * {k}1) * {u_} + ({k}3 - {k}0 + q * {k}3) * {v_} + {k}0) / {d})" for k in ("px", "py")))
    share = "greatest(0, least(x2, l + cw) - greatest(x1, l)) * greatest(0, least(y2, t + ch) - greatest(y1, t))"
    names = "||".join(f"case when on_{n} then '{n}|' else '' end" for n in s)
    return f"""with a as (select image_id, idx, x1, y1, x2, y2, 480::bigint as w, 360::bigint as h, {draws} from gt_boxes),
      b as (select * replace (rotate * {augment.DEGREE}::double as rotate) from a), b1 as (select *, cos(rotate) as c, sin(rotate) as s from b),
      r as (select * exclude (x1, y1, x2, y2), {turn} from b1 where on_rotate union all by name select * from b1 where not on_rotate),
      c0 as (select *, greatest(1, cast(floor(w * random_crop) as bigint)) as cw, greatest(1, cast(floor(h * random_crop) as bigint)) as ch from r),
      c1 as (select * replace (on_random_crop and (cw < w or ch < h) as on_random_crop), cast(floor({u('random_crop.top')} * (h - ch + 1)) as bigint) as t, cast(floor({u('random_crop.left')} * (w - cw + 1)) as bigint) as l from c0),
      cr as (select * replace (greatest(x1, l) - l as x1, greatest(y1, t) - t as y1, least(x2, l + cw) - l as x2, least(y2, t + ch) - t as y2, cw as w, ch as h) from c1
          where on_random_crop and x2 > x1 and y2 > y1 and 2 * ({share}) >= (x2 - x1) * (y2 - y1) and ({share}) > 0 union all select * from c1 where not on_random_crop),
      f as (select * replace (case when on_horizontal_flip then w - x2 else x1 end as x1, case when on_horizontal_flip then w - x1 else x2 end as x2) from cr),
      p0 as (select *, {points} from f), p1 as (select *, px1 - px2 as ax, px3 - px2 as bx, px0 - px1 + px2 - px3 as sx, py1 - py2 as ay, py3 - py2 as bby, py0 - py1 + py2 - py3 as sy from p0),
      p2 as (select *, (sx * bby - sy * bx) / (ax * bby - ay * bx) as p, (ax * sy - ay * sx) / (ax * bby - ay * bx) as q from p1),
      pe as (select * exclude (x1, y1, x2, y2), {warp} from p2 where on_perspective union all by name select * from p2 where not on_perspective),
      j0 as (select *, greatest(1, cast(round_even(w * resize_jitter, 0) as bigint)) as tw, greatest(1, cast(round_even(h * resize_jitter, 0) as bigint)) as th from pe),
      j as (select image_id, idx, on_resize_jitter as z, case when z then tw else w end as w, case when z then th else h end as h, {names} as applied,
          {", ".join(f"case when z then cast(round_even({x} * ({t} / {o}), 0) as bigint) else {x} end as {x}" for x, t, o in (("x1", "tw", "w"), ("y1", "th", "h"), ("x2", "tw", "w"), ("y2", "th", "h")))} from j0),
      k as (select image_id, w, h, applied, idx, {", ".join(f"greatest(0, least({x}, {o} - 1)) as {x}" for x, o in (("x1", "w"), ("y1", "h"), ("x2", "w"), ("y2", "h")))} from (select image_id, idx, w, h, applied, x1, y1, x2, y2 from j))
      select image_id, w, h, rtrim(applied, '|') as applied, idx, x1, y1, x2, y2 from k where x2 > x1 and y2 > y1"""


@query(_chain_sql())
def aug_det_boxes(s, d):
    """The ground truth's boxes after each image's augmentation."""
    b = F.struct("idx", *(F.col(c).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")))
    rows = table(s, d, "gt_boxes").groupBy("image_id").agg(F.collect_list(b).alias("boxes"))
    # A box's number goes along, as it has to outlive the boxes that a crop drops.
    out = augment.detection_boxes(rows.select("image_id", F.lit(480).cast("long").alias("w"), F.lit(360).cast("long").alias("h"), "boxes"))
    out = out.select("image_id", "w", "h", F.array_join("applied", "|").alias("applied"), F.explode("boxes").alias("b"))
    return out.select("image_id", "w", "h", "applied", "b.idx", "b.x1", "b.y1", "b.x2", "b.y2")


def _plan_sql() -> str:
    u = lambda n: _draw("sample_id", n)
    ranged = ("rotate", "stretch_x", "stretch_y", "brightness", "contrast", "gaussian_noise", "gaussian_blur")
    items = []
    for s in augment.RECOGNITION_GEOMETRY + augment.RECOGNITION_LIGHT:
        light = s in augment.RECOGNITION_LIGHT and s.name not in ("jpeg_quality", "grayscale")
        p = f"case when k = 'handwrite' then {s.chance * 0.5} else {s.chance} end" if light else f"case when k = 'date' then {s.chance * 0.9} else {s.chance} end" if s.name == "jpeg_quality" else str(s.chance)
        on = f"{u(s.name)} < ({p})::double" + (" and k <> 'date'" if s.name == "stretch_x" else "")
        if s.name == "erode":
            on += f" and not ({dilate})"
        if s.name == "dilate":
            dilate = on
        mid, half = (s.low + s.high) / 2, (s.high - s.low) / 2
        v = f"floor({u(s.name + '.value')} * {s.high - s.low + 1}) + {s.low}" if s.whole else f"({mid}::double - {half}::double * f) + {u(s.name + '.value')} * (2 * {half}::double * f)" if s.name in ranged else f"{float(s.low)}"
        items.append(f"select sample_id, '{s.name}' as step, cast(round({v}, 6) as double) as value from x where {on}")
    return f"""with y as (select sample_id, {_KIND} as k from rec_samples), x as (select *, case k when 'single_char' then 0.5::double when 'handwrite' then 0.7 else 1.0 end as f from y) {" union all ".join(items)}"""


_KIND = "case when contains(lower(image_path), 'handwrite') then 'handwrite' when length(gt_text) = 1 then 'single_char' when regexp_full_match(gt_text, '[0-9./:\\-~ ]+') then 'date' else 'normal' end"


@query(_plan_sql())
def aug_rec_plan(s, d):
    """What is done to each crop of text, by its type."""
    rows = table(s, d, "rec_samples").select("sample_id", t.text_type(F.col("gt_text"), F.col("image_path")).alias("k"))
    return rows.select("sample_id", F.explode(augment.recognition_plan(F.col("sample_id"), F.col("k"))).alias("s")).select("sample_id", "s.step", F.round("s.value", 6).alias("value"))


def scans(s: SparkSession, d: str, more: DataFrame | None = None) -> DataFrame:
    """A pixel table: lines at an angle that the vector's id gives, in greys that its values give; every third image stands
    upright (its upper quarter is the darker one). more: image_id and cut of the images that are wanted, whose dark pixels
    come; they meet as vectors, before those become pixels."""
    e = table(s, d, "embeddings").where("size(embedding) > 0").select(F.col("vec_id").alias("image_id"), "embedding", F.lit([[c, n] for _, c, n in SKEWS])[(F.col("vec_id") * 7 % len(SKEWS)).cast("int")].alias("t"))
    e = e.join(more, "image_id") if more else e
    rows = e.select("*", F.explode(F.sequence(F.lit(0), F.lit(HIGH - 1))).alias("y")).select("*", F.explode(F.sequence(F.lit(0), F.lit(WIDE - 1))).alias("x"))
    x, y = F.col("x").cast("long"), F.col("y").cast("long")
    row = F.shiftright(F.col("t")[0] * (2 * y + 1 - HIGH) - F.col("t")[1] * (2 * x + 1 - WIDE), pixels.UNIT + 1)
    noise = F.floor(F.abs(F.get("embedding", ((x * 7 + y * 3) % F.size("embedding")).cast("int")).cast("double")) * 100).cast("long")
    v = F.when(F.pmod(row, F.lit(EVERY)) < THICK, 50 + noise).otherwise(200 + noise % 50) - F.when((F.col("image_id") % 3 == 0) & (y < HIGH // 4), 30).when((F.col("image_id") % 3 != 0) & (y >= HIGH - HIGH // 4), 30).otherwise(0)
    found = rows.select("image_id", F.lit(WIDE).cast("long").alias("w"), F.lit(HIGH).cast("long").alias("h"), x.alias("x"), y.alias("y"), v.cast("long").alias("v"), *(["cut"] if more else []))
    return found.where("v <= cut") if more else found


def _table(values: list) -> str:
    return "[" + ", ".join(f"[{c}, {n}]" for _, c, n in values) + "]"


_SCANS = f"""e as (select vec_id as image_id, embedding, list_extract({_table(SKEWS)}, cast(vec_id * 7 % {len(SKEWS)} as int) + 1) as t from embeddings),
    g as (select image_id, embedding, t, y, x from e, range({HIGH}) a(y), range({WIDE}) b(x)),
    raw as (select image_id, x, y, cast(floor(abs(cast(embedding[cast((x * 7 + y * 3) % len(embedding) as int) + 1] as double)) * 100) as bigint) as n, (t[1] * (2 * y + 1 - {HIGH}) - t[2] * (2 * x + 1 - {WIDE})) // {1 << 17} as r0, (t[1] * (2 * y + 1 - {HIGH}) - t[2] * (2 * x + 1 - {WIDE})) % {1 << 17} as rest from g),
    px as materialized (select image_id, x, y, case when ((r0 - cast(rest < 0 as int)) % {EVERY} + {EVERY}) % {EVERY} < {THICK} then 50 + n else 200 + n % 50 end - case when image_id % 3 = 0 and y < {HIGH // 4} then 30 when image_id % 3 <> 0 and y >= {HIGH - HIGH // 4} then 30 else 0 end as v from raw)"""
_CUT = """hist as (select image_id, v, count(*) as n from {px} group by 1, 2),
    cum as (select image_id, v, sum(n) over w as n0, sum(n * v) over w as m0, sum(n) over (partition by image_id) as n, sum(n * v) over (partition by image_id) as m from hist window w as (partition by image_id order by v rows unbounded preceding)),
    cut as (select image_id, arg_max(v, (case when n0 < n then cast(m * n0 - m0 * n as double) * cast(m * n0 - m0 * n as double) / (cast(n0 as double) * cast(n - n0 as double)) else 0.0 end, -v)) as cut from cum group by 1),
    dark as materialized (select p.* from {px} p join cut using (image_id) where v <= cut)"""
_FLOOR = "(({v}) // 131072 - cast(({v}) % 131072 < 0 as int))"
_SKEW = f"""ang as (select unnest(range({len(pixels.angles(LOW, TOP, STEP))})) as i, unnest({_table(pixels.angles(LOW, TOP, STEP))}) as t),
    turned as (select image_id, i, {_FLOOR.format(v=f"t[1] * (2 * y + 1 - {HIGH}) - t[2] * (2 * x + 1 - {WIDE}) + {HIGH} * 65536")} as r, {_FLOOR.format(v=f"t[1] * (2 * x + 1 - {WIDE}) + t[2] * (2 * y + 1 - {HIGH}) + {WIDE} * 65536")} as c from dark, ang),
    prof as (select image_id, i, r, count(*) as n from turned where r between 0 and {HIGH - 1} and c between 0 and {WIDE - 1} group by all),
    sk as (select image_id, {LOW} + arg_max(i, (score, -i)) * {STEP} as angle from (select image_id, i, sum(n * n) * {HIGH} - sum(n) * sum(n) as score from prof group by all) group by 1)"""


@query(f"with {_SCANS}, {_CUT.format(px='px')}, {_SKEW} select image_id, cast(angle as double) as angle from sk")
def img_skew(s, d):
    """The skew of each image, by projections of its dark pixels."""
    return pixels.skew(scans(s, d, pixels.threshold(scans(s, d))), low=LOW, high=TOP, step=STEP)


@query(f"""with {_SCANS}, orient as (select image_id, avg(v) filter (where y >= {HIGH - HIGH // 4}) < avg(v) filter (where y < {HIGH // 4}) - 5 as turned from px group by 1),
    up as materialized (select image_id, case when turned then {WIDE - 1} - x else x end as x, case when turned then {HIGH - 1} - y else y end as y, v, turned from px join orient using (image_id)),
    lap as materialized (select image_id, x, y, v, coalesce(lag(v) over r, lead(v) over r) + coalesce(lead(v) over r, lag(v) over r) + coalesce(lag(v) over c, lead(v) over c) + coalesce(lead(v) over c, lag(v) over c) - 4 * v as l
      from up window r as (partition by image_id, y order by x), c as (partition by image_id, x order by y)),
    sh as (select image_id, cast(sum(l * l) * count(*) - sum(l) * sum(l) as double) / (count(*) * count(*)) as sharpness from lap group by 1),
    clear as materialized (select image_id, x, y, case when sharpness < 10000 then greatest(0, least(255, v - l)) else v end as v from lap join sh using (image_id)), {_CUT.format(px='clear')}, {_SKEW}
    select image_id, {WIDE}::bigint as w, {HIGH}::bigint as h, turned as angle_corrected, round(sharpness, 4) as sharpness, sharpness < 10000 as sharpened, case when abs(angle) < 0.5 then 0.0 else angle end::double as deskew_angle, abs(angle) >= 0.5 as deskewed,
      128::bigint as padded_w, 64::bigint as padded_h, 'resolution_below_720px' as warning from orient join sh using (image_id) join sk using (image_id)""")
def img_prepared(s, d):
    """What the preparation of each image comes to."""
    out = pixels.prepared(scans(s, d), sharp=10000.0, low=LOW, high=TOP, step=STEP)
    return out.withColumn("sharpness", F.round("sharpness", 4))


@query("""with b as (select image_id, greatest(0, x1 // 4) as a, least(119, x2 // 4) as b, greatest(0, y1 // 4) as c, least(89, y2 // 4) as d from gt_boxes),
    c as (select distinct image_id, x, unnest(range(c, d)) as y from (select image_id, unnest(range(a, b)) as x, c, d from b where b > a and d > c)) select image_id, count(*) as cells from c group by 1""")
def det_target_area(s, d):
    """How many cells of each image's training target its boxes cover."""
    b = table(s, d, "gt_boxes").select("image_id", F.lit(480).cast("long").alias("w"), F.lit(360).cast("long").alias("h"), *(F.col(c).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")))
    return raster.covered(b)
