"""Queries of single rules over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrivena.functions import geometry as g
from scrivena.functions import scalars
from scrivena.functions import text as t
from scrivena.operators import annotation, charset, feedback, recognition, registry, training
from scrivena.plans.fixtures import table
from scrivena.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_LEVEL = "case when {c} >= 0.9 then 'high' when {c} < 0.7 then 'low' else 'mid' end"


def query(sql: str) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


@query("select doc_id, abs(tilt_degrees) > 15 as polygons from quality_snapshots")
def ann_polygon_mode(s, d):
    return table(s, d, "quality_snapshots").select("doc_id", annotation.needs_polygons(F.col("tilt_degrees")).alias("polygons"))


@query("select l_orderkey, l_linenumber, case when l_linestatus = 'O' and l_quantity < 10 then 'unreadable' when l_quantity > 40 then 'difficult' else 'normal' end as legibility from lineitem")
def ann_legibility(s, d):
    text = F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") < 10), t.UNREADABLE).otherwise(F.col("l_returnflag"))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", annotation.legibility(text, F.col("l_quantity") > 40).alias("legibility"))


@query("select s_suppkey, s_suppkey % 20 <= 10 as passed from supplier")
def reg_equivalence(s, d):
    """Largest differences of exported models, in millionths."""
    return table(s, d, "supplier").select("s_suppkey", annotation.equivalent((F.col("s_suppkey") % 20) / 1e6).alias("passed"))


@query("select image_id, seq, text, x1, case when seq % 3 = 0 then 1.0 else 0.5 end::double as score from tokens where seq % 4 <> 1 and text <> 'R'")
def tok_usable(s, d):
    """Tokens without text or box go; a score that is missing is 1."""
    rows = table(s, d, "tokens").select("image_id", "seq", "x1", F.when(F.col("text") != "R", F.col("text")).alias("text"), F.when(F.col("seq") % 4 != 1, F.array("x1", "y1", "x2", "y2")).alias("bbox"), F.when(F.col("seq") % 3 != 0, 0.5).alias("score"))
    return feedback.usable_tokens(rows).select("image_id", "seq", "text", "x1", "score")


@query(f"""with c as (select import_id, event_id as pos, confidence, case when event_id % 5 = 0 then 'own' || event_id else import_id || '_cell' || lpad(cast(event_id + 1 as varchar), cast(greatest(3, length(cast(event_id + 1 as varchar))) as int), '0') end as cell_id from feedback)
    select import_id, true as enabled, string_agg(cell_id || ':' || {_LEVEL.format(c='confidence')}, '|' order by pos) as entries from c group by 1""")
def conf_roster_payload(s, d):
    """The answer for each import: its cells in order, with level and id; some bring an id of their own."""
    f = table(s, d, "feedback")
    cells = f.select("import_id", F.col("event_id").cast("int").alias("pos"), F.col("original_text").alias("text"), "confidence", F.array().cast("array<int>").alias("bbox"), F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("own"), F.col("event_id").cast("string"))).alias("cell_id"))
    out = annotation.roster_payload(cells, f.select("import_id").distinct())
    return out.select("import_id", "enabled", F.array_join(F.transform("entries", lambda e: F.concat(e["cell_id"], F.lit(":"), e["confidence_level"])), "|").alias("entries"))


@query("""with b as (select *, coalesce(loss_total < min(loss_total) over (partition by run_id order by step rows between unbounded preceding and 1 preceding), true) as better, row_number() over (partition by run_id order by step desc) as k from train_log),
    m as (select *, max(step) filter (where better) over (partition by run_id) as top from b) select run_id, step, step = top as is_best, k = 1 as is_last from m where k <= 2 or step = top""")
def ckpt_retention(s, d):
    """The checkpoints that stay of each run: the best loss, and the last two."""
    return training.Retention("loss_total", "min", 2).kept(table(s, d, "train_log")).select("run_id", "step", "is_best", "is_last")


@query("select user_id, event_id, event_id % 30 >= 5 and value > 30 as bad from events")
def ckpt_epoch_health(s, d):
    """A validation loss ten times the training loss, from the fifth epoch on."""
    e = table(s, d, "events")
    return e.select("user_id", "event_id", (F.size(training.epoch_issues(F.col("event_id") % 30, F.lit(3.0), F.col("value"))) > 0).alias("bad"))


@query("select image_id, idx, greatest(0, least(x1, 299)) as x1, greatest(0, least(y1, 199)) as y1, greatest(0, least(x2, 299)) as x2, greatest(0, least(y2, 199)) as y2 from gt_boxes where greatest(0, least(x2, 299)) > greatest(0, least(x1, 299)) and greatest(0, least(y2, 199)) > greatest(0, least(y1, 199))")
def box_clip_all(s, d):
    rows = table(s, d, "gt_boxes").select("image_id", "idx", g.clip_all(F.array(F.struct("x1", "y1", "x2", "y2")), 300, 200).alias("b"))
    return rows.select("image_id", "idx", F.explode_outer("b").alias("b")).where("b is not null").select("image_id", "idx", "b.*")


@query("select image_id, idx, cast(trunc(greatest(0, least(0.5 * x1 + 0.25 * y1 + 10, 399))) as bigint) as x1, cast(trunc(greatest(0, least(0.5 * y1 + 3, 299))) as bigint) as y1, cast(trunc(greatest(0, least(0.5 * x2 + 0.25 * y2 + 10, 399))) as bigint) as x2, cast(trunc(greatest(0, least(0.5 * y2 + 3, 299))) as bigint) as y2 from gt_boxes")
def box_affine(s, d):
    b = F.struct("x1", "y1", "x2", "y2")
    return table(s, d, "gt_boxes").select("image_id", "idx", g.affine(b, [[0.5, 0.25, 10.0], [0.0, 0.5, 3.0]], 400, 300).alias("b")).select("image_id", "idx", "b.*")


@query("""with p as (select image_id, idx, greatest(0, least(x1 / (0.001::double * y1 + 1), 399)) as a, greatest(0, least(x1 / (0.001::double * y2 + 1), 399)) as b, greatest(0, least(x2 / (0.001::double * y1 + 1), 399)) as c, greatest(0, least(x2 / (0.001::double * y2 + 1), 399)) as d,
      greatest(0, least(y1 / (0.001::double * y1 + 1), 299)) as e, greatest(0, least(y2 / (0.001::double * y2 + 1), 299)) as f from gt_boxes)
    select image_id, idx, cast(trunc(least(a, b, c, d)) as bigint) as x1, cast(trunc(least(e, f)) as bigint) as y1, cast(trunc(greatest(a, b, c, d)) as bigint) as x2, cast(trunc(greatest(e, f)) as bigint) as y2 from p""")
def box_perspective(s, d):
    b = F.struct("x1", "y1", "x2", "y2")
    return table(s, d, "gt_boxes").select("image_id", "idx", g.perspective(b, [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.001, 1.0]], 400, 300).alias("b")).select("image_id", "idx", "b.*")


@query("select image_id, idx, x1 || ',' || y1 || ' ' || x2 || ',' || y1 || ' ' || x2 || ',' || y2 || ' ' || x1 || ',' || y2 as polygon, greatest(1, x2 - x1) as width, greatest(1, y2 - y1) as height from gt_boxes")
def box_polygon(s, d):
    b = F.struct("x1", "y1", "x2", "y2")
    points = F.array_join(F.transform(g.polygon(b), lambda p: F.concat_ws(",", p[0].cast("string"), p[1].cast("string"))), " ")
    return table(s, d, "gt_boxes").select("image_id", "idx", points.alias("polygon"), g.width(b).alias("width"), g.height(b).alias("height"))


@query("select image_path, gt_text, pred_text, case when gt_text = pred_text then 'True' else 'False' end as match from rec_samples where gt_text <> ''")
def rec_error_table(s, d):
    return recognition.error_table(recognition.samples(table(s, d, "rec_samples")))


@query("select version, case when version = 'v1.1.0' then 'active' when status = 'active' then 'deprecated' else status end as status from versions")
def reg_rollback(s, d):
    return registry.rollback(table(s, d, "versions"), "v1.1.0", force=True).select("version", "status")


@query("select version, issue from (select case when seq % 7 <> 0 then version end as version, unnest(list_filter([case when seq % 7 = 0 then 'missing_version' end, case when seq % 5 = 0 then 'missing_status' end, case when seq % 5 <> 0 and seq % 11 = 0 then 'unknown_status' end], lambda x: x is not null)) as issue from versions)")
def reg_issues(s, d):
    v = table(s, d, "versions").select(F.when(F.col("seq") % 7 != 0, F.col("version")).alias("version"), F.when(F.col("seq") % 5 != 0, F.when(F.col("seq") % 11 == 0, "lost").otherwise(F.col("status"))).alias("status"))
    return registry.issues(v)


@query("select s_suppkey, abs(s_acctbal - (s_acctbal + s_suppkey % 3)) <= 1 as passed from supplier")
def reg_metric_delta(s, d):
    return table(s, d, "supplier").select("s_suppkey", registry.metric_delta(F.col("s_acctbal"), F.col("s_acctbal") + F.col("s_suppkey") % 3, 1.0).alias("passed"))


@query("select event_id, event_type not in ('click', 'view') as flag from events")
def cfg_flags(s, d):
    """Flags of a configuration: all is true but a few words, whatever their case and spaces."""
    raw = F.when(F.col("event_type") == "click", " OFF ").when(F.col("event_type") == "view", "No").otherwise(F.col("event_type"))
    return table(s, d, "events").select("event_id", scalars.parse_bool(raw).alias("flag"))


@query("select 'missing_character' as issue, ch as token from (select distinct unnest(string_split(text, '')) as ch from documents) where ch <> '' and ch not in ('a', 'b', 'c', 'é') union all select 'duplicate_token', 'b' union all select 'last_token_not_blank', 'b'")
def charset_issues(s, d):
    """What a small dictionary lacks for all documents."""
    tokens = s.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "é"), (4, "b")], "idx int, token string")
    chars = table(s, d, "documents").select(F.explode(F.split("text", "")).alias("ch")).where("ch <> ''").groupBy("ch").agg(F.count("*").alias("count"))
    return charset.dictionary_issues(tokens, chars)


@query("""select l_orderkey as image_id, 'img/' || l_orderkey || '.jpg' || chr(9) || '[' || string_agg('{"transcription":"' || l_returnflag || '","difficult":' || case when l_linenumber % 2 = 0 then 'true' else 'false' end || '}', ',' order by l_linenumber, l_returnflag) || ']' as line from lineitem group by 1""")
def sink_detection_lines(s, d):
    """Label lines as they are written."""
    p = F.struct("l_linenumber", F.col("l_returnflag").alias("transcription"), (F.col("l_linenumber") % 2 == 0).alias("difficult"))
    rows = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("image_id")).agg(F.array_sort(F.collect_list(p)).alias("p"))
    kept = F.transform("p", lambda x: F.struct(x["transcription"].alias("transcription"), x["difficult"].alias("difficult")))
    return rows.select("image_id", sinks.detection_line(F.concat(F.lit("img/"), F.col("image_id").cast("string"), F.lit(".jpg")), kept).alias("line"))
