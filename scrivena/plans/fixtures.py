"""Domain tables derived from the driver's tables, as SQL that Spark and DuckDB both run with equal results.

Each entry is a query over driver tables and earlier entries. Only integer arithmetic and one final division are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SQL: dict[str, str] = {
    # Ground-truth boxes, and predictions that are shifted or missing.
    "gt_boxes": """
        select image_id, idx, (p * 7) % 400 as x1, (s * 11) % 300 as y1, (p * 7) % 400 + 20 + q as x2,
               (s * 11) % 300 + 12 + ln * 2 as y2, (p % 9) = 0 as difficult
        from (select l_orderkey as image_id, cast(l_linenumber as bigint) as ln, l_partkey as p, l_suppkey as s, cast(l_quantity as bigint) as q,
                     cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as int) as idx
              from lineitem) li""",
    "pred_boxes": """
        select image_id, cast(row_number() over (partition by image_id order by idx) - 1 as int) as idx,
               x1 + (x2 % 5) as x1, y1 + (y2 % 4) as y1, x2 + (x1 % 7) as x2, y2 + (y1 % 3) as y2
        from gt_boxes where (x1 + y1) % 6 <> 0""",
    "image_meta": """
        select distinct l_orderkey as image_id,
          case l_orderkey % 5 when 0 then 'paper' when 1 then 'scan' when 2 then 'screen' when 3 then 'excel' else 'handwrite' end as format,
          case l_orderkey % 6 when 0 then 'hospital' when 1 then 'convenience' when 2 then 'factory' when 3 then 'office' when 4 then 'food' else 'etc' end as industry
        from lineitem""",
    "rec_samples": """
        select sample_id, image_path, gt_text,
               case sample_id % 3 when 0 then gt_text when 1 then translate(gt_text, 'oieDF0', '01cOE8')
                    else substr(gt_text, 1, length(gt_text) - 1) end as pred_text
        from (select p_partkey as sample_id,
                case p_partkey % 4 when 0 then upper(substr(p_name, 1, 1))
                  when 1 then concat(lpad(cast(p_size % 24 as string), 2, '0'), ':', lpad(cast(p_partkey % 60 as string), 2, '0'))
                  when 2 then case (p_partkey * 7) % 5 when 0 then 'D' when 1 then 'OFF' when 2 then 'AL' when 3 then 'Open' else 'PM' end
                  else p_name end as gt_text,
                concat(case when p_partkey % 10 = 0 then 'handwrite/' else 'crop/' end, cast(p_partkey as string), '.png') as image_path
              from part) g""",
    "schedule_gt": """
        select image_id, worker, day, gt_code, order_id from (
          select cast(year(o_orderdate) * 100 + month(o_orderdate) as bigint) as image_id, o_custkey as worker, cast(day(o_orderdate) as int) as day,
            case substr(o_orderpriority, 1, 1) when '1' then 'D' when '2' then 'E' when '3' then 'N' when '4' then 'A' else 'OFF' end as gt_code,
            o_orderkey as order_id,
            row_number() over (partition by o_custkey, o_orderdate order by o_orderkey) as rn
          from orders) t where rn = 1""",
    "schedule_pred": """
        select image_id, worker, day, case when order_id % 11 = 0 then '' when order_id % 7 = 0 then 'X' else gt_code end as pred_code
        from schedule_gt where order_id % 13 <> 0 and worker % 17 <> 0 and image_id % 10 <> 3""",
    "schedule_meta": """
        select distinct image_id, image_id % 10 <> 3 as parse_success,
          case image_id % 5 when 0 then 'paper' when 1 then 'scan' when 2 then 'screen' when 3 then 'excel' else 'handwrite' end as format,
          case image_id % 6 when 0 then 'hospital' when 1 then 'convenience' when 2 then 'factory' when 3 then 'office' when 4 then 'food' else 'etc' end as industry
        from schedule_gt""",
    "tokens": """
        select image_id, seq, text, x1, y1, x1 + 30 as x2, y1 + 20 as y2 from (
          select l_orderkey as image_id,
            cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as int) as seq,
            case when l_suppkey % 4 = 0 then cast(1 + l_linenumber % 31 as string) else l_returnflag end as text,
            cast(l_linenumber % 8 as bigint) * 50 + l_partkey % 7 as x1, (l_suppkey % 4) * 40 + l_partkey % 5 as y1
          from lineitem) t""",
    "quality_snapshots": """
        select doc_id, 400 + n_chars % 2000 as width, 500 + (doc_id * 37) % 1500 as height,
          cast(doc_id % 100 as double) / 100 as text_area_ratio, cast(doc_id % 90 - 45 as double) as tilt_degrees,
          cast((doc_id * 3) % 100 as double) / 100 as legibility_ratio, n_chars * 400 as file_size_bytes, md5(text) as file_md5,
          doc_id % 31 = 0 as has_motion_blur, cast(doc_id % 64 as double) / 100 as masked_text_ratio, doc_id % 43 = 0 as is_non_schedule_image
        from documents""",
    "images": """
        select concat(lang, '_', cast(doc_id as string), '.png') as filename, doc_id,
          case when doc_id % 4 = 0 then 'synthetic' else 'masked' end as source, lang as format, source as industry,
          n_chars % 9 = 0 as difficult, n_chars % 50 as detection_boxes, n_chars, 400 + n_chars % 2000 as width, 500 + (doc_id * 37) % 1500 as height, md5(text) as file_md5
        from documents""",
    "feedback": """
        select event_id, concat('imp_', cast(user_id as string)) as import_id, event_type as original_text,
          case when event_id % 3 = 0 then event_type else translate(event_type, 'ie', '1c') end as corrected_text,
          cast((event_id * 7) % 101 as double) / 100 as confidence, event_id % 5 <> 0 as crop_saved, ts
        from events""",
    "train_log": """
        select user_id as run_id, cast(row_number() over (partition by user_id order by event_id) as bigint) as step, value as loss_total, value * 20 as grad_norm
        from events""",
    "versions": """
        select concat('v', cast(s_suppkey % 3 as string), '.', cast(s_suppkey as string), '.0') as version,
          case s_nationkey % 4 when 0 then 'active' when 1 then 'superseded' when 2 then 'deprecated' else 'rollback_candidate' end as status,
          s_acctbal as score, s_suppkey as seq
        from supplier""",
    "crops": """
        select concat('doc_', cast(doc_id as string), '_', cast(k as string), '.png') as crop_name, concat(lang, cast(k as string)) as crop_text
        from documents, (select 0 as k union all select 1 union all select 2 union all select 3) ks where k < n_chars % 4""",
}


def needed(sql: str) -> list[str]:
    """The entries that a query uses, each after those that it needs itself."""
    import re

    found: list[str] = []
    for name in SQL:
        if re.search(rf"\b{name}\b", sql):
            found += [x for x in (*needed(SQL[name]), name) if x not in found]
    return found


def duck(sql: str) -> str:
    """A DuckDB query over the driver's views, with the entries that it needs in front."""
    names = needed(sql)
    if not names:
        return sql
    body = ", ".join(f"{n} as ({SQL[n]})" for n in names)
    # What comes first in the query itself may already be a list of named tables.
    text = sql.strip()
    low = text.lower()
    if low.startswith("with recursive"):
        return f"with recursive {body}, {text[14:]}"
    return f"with {body}, {text[4:]}" if low.startswith("with") else f"with {body} {text}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or an entry, as a DataFrame."""
    if name not in SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    import re

    used = {n: table(spark, sf_dir, n) for n in (*SQL, *TABLES) if n != name and re.search(rf"(?:from|join|,)\s+{n}\b", SQL[name])}
    return spark.sql(re.sub(r"\b(from|join)\s+(\w+)\b", lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], SQL[name]), **used)
