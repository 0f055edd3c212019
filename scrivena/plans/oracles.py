"""DuckDB SQL with the rows of the registered queries. Names of derived tables stand for the SQL in fixtures."""

from __future__ import annotations

from scrivena.operators.charset import CODES, JAMO, PUNCTUATION
from scrivena.operators.gates import ACTIONS, CRITERIA
from scrivena.operators.synthetic import AUGMENTATIONS
from scrivena.plans import files, images, rules, streams, training_sets
from scrivena.plans.fixtures import duck

_Q: dict[str, str] = {}

_IOU = """cand as (select image_id, pi, gi, iou from (
    select p.image_id, p.idx as pi, g.idx as gi,
      cast(greatest(0, least(g.x2, p.x2) - greatest(g.x1, p.x1)) * greatest(0, least(g.y2, p.y2) - greatest(g.y1, p.y1)) as double) as i,
      cast((g.x2 - g.x1) * (g.y2 - g.y1) + (p.x2 - p.x1) * (p.y2 - p.y1) as double) as s
    from gt_boxes g join pred_boxes p on g.image_id = p.image_id) x, lateral (select case when i <= 0 then 0.0 else i / (s - i) end as iou) y where iou >= {thr}),
  steps as (select image_id, list_reduce(list([{{'pi': pi, 'gi': gi, 'iou': iou}}] order by iou desc, pi, gi),
      lambda a, x: case when len(list_filter(a, lambda m: m.pi = x[1].pi or m.gi = x[1].gi)) > 0 then a else a || x end) as m from cand group by image_id),
  matched as (select image_id, u.pi as pi, u.gi as gi, u.iou as iou from (select image_id, unnest(m) as u from steps))"""
_COUNTS = """counts as (select coalesce(t.image_id, p.image_id) as image_id, coalesce(m.tp, 0) as tp, coalesce(p.n, 0) - coalesce(m.tp, 0) as fp,
      coalesce(t.n, 0) - coalesce(m.tp, 0) - coalesce(t.h, 0) + coalesce(m.h, 0) as fn, coalesce(t.n, 0) - coalesce(t.h, 0) as num_gt, coalesce(p.n, 0) as n_pred
    from (select image_id, count(*) as n, cast(sum(cast(difficult as int)) as bigint) as h from gt_boxes group by 1) t
    full join (select image_id, count(*) as n from pred_boxes group by 1) p on t.image_id = p.image_id
    left join (select m.image_id, count(*) as tp, cast(sum(cast(g.difficult as int)) as bigint) as h from matched m join gt_boxes g on g.image_id = m.image_id and g.idx = m.gi group by 1) m
      on m.image_id = coalesce(t.image_id, p.image_id))"""


def _div(a: str, b: str) -> str:
    return f"(case when ({b}) = 0 or ({b}) is null then 0.0 else cast({a} as double) / ({b}) end)"


_P, _R = _div("tp", "tp + fp"), _div("tp", "tp + fn")
_FIG = f"round({_P}, 6) as precision, round({_R}, 6) as recall, round({_div(f'2 * {_P} * {_R}', f'{_P} + {_R}')}, 6) as f1"


def _summed(by: str, thr: float = 0.5) -> str:
    key, join = (f"{by}, ", "left join image_meta using (image_id)") if by else ("", "")
    group = f"group by {by}" if by else ""
    return f"""with {_IOU.format(thr=thr)}, {_COUNTS}
    select {key}tp, fp, fn, tp + fp as num_pred, tp + fn as num_gt, {_FIG}, sample_count
    from (select {key}cast(sum(tp) as bigint) as tp, cast(sum(fp) as bigint) as fp, cast(sum(fn) as bigint) as fn, count(*) as sample_count from counts {join} {group})"""


_M = f"with {_IOU.format(thr=0.5)}"
_Q["det_matches"] = _M + " select image_id, pi, gi, round(iou, 6) as iou from matched"
_Q["det_micro"] = _summed("")
_Q["det_micro_iou_03"] = _summed("", 0.3)
_Q["det_by_format"] = _summed("format")
_Q["det_by_industry"] = _summed("industry")
_Q["det_breakdowns"] = " union all ".join(f"select '{a}' as attribute, {v} as value, tp, fp, fn, num_pred, num_gt, precision, recall, f1, sample_count from ({_summed(c)})" for a, v, c in (("format", "format", "format"), ("industry", "industry", "industry"), ("all", "null", "")))
_Q["det_per_image"] = f"{_M}, {_COUNTS} select image_id, tp, fp, fn, num_gt, n_pred as num_pred, {_FIG} from counts"
_Q["det_lowest_f1"] = f"{_M}, {_COUNTS} select image_id, f1 from (select image_id, {_FIG} from counts) order by f1, image_id limit 5"
_Q["det_error_analysis"] = f"""{_M}, area as (select avg(cast((x2 - x1) * (y2 - y1) as double)) as m from gt_boxes),
    miss as (select g.* from gt_boxes g anti join (select image_id, gi as idx from matched) h using (image_id, idx) where not difficult),
    fpos as (select p.* from pred_boxes p anti join (select image_id, pi as idx from matched) h using (image_id, idx)),
    hits as (select g.* from gt_boxes g semi join (select image_id, gi as idx from matched) h using (image_id, idx)),
    fp as (select case when (x2 - x1) / greatest(1e-6, y2 - y1) > 10 or (x2 - x1) / greatest(1e-6, y2 - y1) < 0.1 then 'grid_line_false_positive'
        when exists (select 1 from hits h where h.image_id = f.image_id and
          greatest(0, least(h.x2, f.x2) - greatest(h.x1, f.x1)) * greatest(0, least(h.y2, f.y2) - greatest(h.y1, f.y1)) > 0.3 *
          ((h.x2 - h.x1) * (h.y2 - h.y1) + (f.x2 - f.x1) * (f.y2 - f.y1) - greatest(0, least(h.x2, f.x2) - greatest(h.x1, f.x1)) * greatest(0, least(h.y2, f.y2) - greatest(h.y1, f.y1)))) then 'duplicate_detection'
        when (x2 - x1) * (y2 - y1) < 18 then 'small_noise' else 'other_false_positive' end as label from fpos f),
    fn as (select case when (x2 - x1) * (y2 - y1) < 0.3 * (select m from area) then 'small_cell_miss'
        when exists (select 1 from gt_boxes o where o.image_id = t.image_id and (o.x1, o.y1, o.x2, o.y2) <> (t.x1, t.y1, t.x2, t.y2)
          and (abs((o.x1 + o.x2) / 2.0 - (t.x1 + t.x2) / 2.0) < 5 or abs((o.y1 + o.y2) / 2.0 - (t.y1 + t.y2) / 2.0) < 5)) then 'dense_region_miss'
        else 'blur_or_hard_text_miss' end as label from miss t)
    select kind, label, count(*) as count from (select 'fp' as kind, label from fp union all select 'fn', label from fn) group by 1, 2"""
_Q["det_mean_iou"] = """with x as (select cast(greatest(0, least(g.x2, p.x2) - greatest(g.x1, p.x1)) * greatest(0, least(g.y2, p.y2) - greatest(g.y1, p.y1)) as double) as i,
      cast((g.x2 - g.x1) * (g.y2 - g.y1) + (p.x2 - p.x1) * (p.y2 - p.y1) as double) as s from gt_boxes g join pred_boxes p using (image_id, idx))
    select round(m, 6) as mean_iou, m >= 0.85 as passed from (select coalesce(avg(case when i <= 0 then 0.0 else i / (s - i) end), 0.0) as m from x)"""
_Q["box_filter_topn"] = """select image_id, idx, score from (select *, row_number() over (partition by image_id order by idx) as rn from (
    select image_id, idx, cast((x1 * 3 + y1) % 100 as double) / 100.0 as score, x1, y1, x2, y2 from pred_boxes) where score >= 0.6 and least(x2 - x1, y2 - y1) >= 3) where rn <= 2"""
_E = lambda x: f"cast(round_even({x}, 0) as bigint)"
_Q["box_unclip"] = f"""select image_id, idx, {_E('(x1 + x2) / 2.0 - (x2 - x1) * 0.75')} as x1, {_E('(y1 + y2) / 2.0 - (y2 - y1) * 0.75')} as y1,
    {_E('(x1 + x2) / 2.0 + (x2 - x1) * 0.75')} as x2, {_E('(y1 + y2) / 2.0 + (y2 - y1) * 0.75')} as y2 from gt_boxes"""
_RX = lambda v: f"greatest(0, least({_E(f'({v} - 16) / (736.0 / 900.0)')}, 900))"
_RY = lambda v: f"greatest(0, least({_E(f'({v} - 0) / (960.0 / 1200.0)')}, 1200))"
_Q["box_restore"] = f"""select image_id, idx, least(a, c) as x1, least(b, d) as y1, greatest(a, c) as x2, greatest(b, d) as y2 from (
    select image_id, idx, {_RX('x1')} as a, {_RY('y1')} as b, {_RX('x2')} as c, {_RY('y2')} as d from gt_boxes)"""
_Q["box_clip"] = """select image_id, idx, least(a, c) as x1, least(b, d) as y1, greatest(a, c) as x2, greatest(b, d) as y2 from (
    select image_id, idx, greatest(0, least(x1, 300)) as a, greatest(0, least(y1, 200)) as b, greatest(0, least(x2, 300)) as c, greatest(0, least(y2, 200)) as d from gt_boxes)"""
_Q["box_flip"] = "select image_id, idx, 480 - x2 as x1, y1, 480 - x1 as x2, y2 from gt_boxes"
_Q["box_crop"] = """select image_id, greatest(x1, 100) - 100 as x1, greatest(y1, 50) - 50 as y1, least(x2, 300) - 100 as x2, least(y2, 250) - 50 as y2 from gt_boxes
    where (x2 - x1) * (y2 - y1) > 0 and cast(greatest(0, least(x2, 300) - greatest(x1, 100)) * greatest(0, least(y2, 250) - greatest(y1, 50)) as double) / ((x2 - x1) * (y2 - y1)) >= 0.5"""
_Q["resize_shapes"] = f"""select doc_id, rw as resized_w, rh as resized_h, cast(ceil(rw / 32.0) * 32 as bigint) as padded_w, cast(ceil(rh / 32.0) * 32 as bigint) as padded_h,
    cast(ceil(rw / 32.0) * 32 as bigint) - rw as pad_right, cast(ceil(rh / 32.0) * 32 as bigint) - rh as pad_bottom, rec_w from (
    select doc_id, greatest(32, {_E('width * least(1.0, 960.0 / greatest(width, height))')}) as rw, greatest(32, {_E('height * least(1.0, 960.0 / greatest(width, height))')}) as rh,
      greatest(1, {_E('width * (32.0 / greatest(height, 1))')}) as rec_w from quality_snapshots)"""
_Q["model_shapes"] = """select doc_id, level, height // stride as map_h, width // stride as map_w,
    array_to_string(list_filter([case when greatest(height, width) > 960 then 'side_too_long' end, case when height % 32 <> 0 or width % 32 <> 0 then 'side_not_multiple_of_32' end], lambda x: x is not null), '|') as issues
    from quality_snapshots, (values (cast(2 as bigint), 4), (3, 8), (4, 16), (5, 32)) v(level, stride)"""

_CODES_IN = "('D','E','N','A','B','C','OFF','OT','AL','SL','CL','PH','AM','PM','OP','MD','FT','PT','Open','Close','Mid','Full','Part')"
_TYPE = "case when lower(image_path) like '%handwrite%' then 'handwrite' when length(gt_text) = 1 then 'single_char' when regexp_full_match(gt_text, '[0-9./:\\-~ ]+') then 'date' else 'normal' end"
_BUCKET = "case when length(gt_text) <= 1 then '1' when length(gt_text) = 2 then '2' when length(gt_text) <= 5 then '3-5' when length(gt_text) <= 10 then '6-10' else '11+' end"
_S = f"""s as (select *, {_div('distance', 'gt_length')} as cer, {_div('distance', 'greatest(gt_length, length(pred_text))')} as normalized_cer, distance = 0 as is_correct from (
    select sample_id, image_path, gt_text, pred_text, {_TYPE} as text_type, cast(levenshtein(pred_text, gt_text) as bigint) as distance, cast(length(gt_text) as bigint) as gt_length
    from rec_samples where gt_text not in ('', '###')))"""
_RATE = f"count(is_correct) as sample_count, coalesce(cast(sum(cast(is_correct as int)) as bigint), 0) as correct, round({_div('sum(distance)', 'sum(gt_length)')}, 6) as cer, round(case when count(is_correct) > 0 then 1 - {_div('sum(cast(is_correct as int))', 'count(is_correct)')} else 0.0 end, 6) as wer, round({_div('coalesce(sum(cast(is_correct as int)), 0)', 'count(is_correct)')}, 6) as accuracy"
_DOM = f"round({_div(f'count(*) filter (is_correct and gt_text in {_CODES_IN})', f'count(*) filter (gt_text in {_CODES_IN})')}, 6) as work_code_accuracy, round({_div(chr(99) + 'ount(*) filter (is_correct and text_type = ' + chr(39) + 'date' + chr(39) + ')', 'count(*) filter (text_type = ' + chr(39) + 'date' + chr(39) + ')')}, 6) as date_exact_match"
_Q["rec_per_sample"] = f"with {_S} select sample_id, text_type, distance, round(cer, 6) as cer, round(normalized_cer, 6) as normalized_cer, is_correct from s"
_Q["rec_summary"] = f"with {_S} select *, cer <= 0.03 and wer <= 0.05 and accuracy >= 0.9 and work_code_accuracy >= 0.95 as targets_met from (select {_RATE}, round(coalesce(avg(normalized_cer), 0.0), 6) as normalized_cer, {_DOM} from s)"
_Q["rec_domain"] = f"with {_S} select {_DOM} from s"
_Q["rec_by_type"] = f"with {_S} select text_type, coalesce(sample_count, 0) as sample_count, coalesce(correct, 0) as correct, coalesce(cer, 0) as cer, coalesce(wer, 0) as wer, coalesce(accuracy, 0) as accuracy from (values ('single_char'), ('date'), ('handwrite'), ('normal')) k(text_type) left join (select text_type, {_RATE} from s group by 1) using (text_type)"
_Q["rec_by_length"] = f"with {_S} select bucket, coalesce(sample_count, 0) as sample_count, coalesce(round(mean_cer, 6), 0) as mean_cer from (values ('1'), ('2'), ('3-5'), ('6-10'), ('11+')) k(bucket) left join (select {_BUCKET} as bucket, count(*) as sample_count, avg(cer) as mean_cer from s group by 1) using (bucket)"
_Q["rec_worst_cer"] = f"with {_S} select sample_id, gt_text, pred_text, round(cer, 6) as cer from s order by s.cer desc, sample_id limit 50"
_Q["text_types"] = f"""select sample_id, {_TYPE} as eval_type, case when length(gt_text) = 1 then 'single_char' when regexp_matches(gt_text, '[0-9]') and regexp_matches(gt_text, '[/.:-]') then 'date'
    when regexp_matches(lower(regexp_extract(image_path, '([^/]*)$', 1)), 'hand|write') then 'handwrite' else 'normal' end as train_type, {_BUCKET} as bucket,
    case when length(gt_text) <= 1 then '1' when length(gt_text) <= 4 then '2-4' when length(gt_text) <= 10 then '5-10' else '11+' end as dataset_bucket from rec_samples"""
_Q["filename_metadata"] = """select p_partkey as k, case p_partkey % 3 when 0 then 'render' when 1 then 'scan' else 'unknown' end as format, case p_partkey % 3 when 0 then 'office' when 1 then 'hospital' else 'unknown' end as industry,
    case p_partkey % 3 when 0 then 'handwrite' when 1 then 'scan' else 'paper' end as dataset_format, case p_partkey % 3 when 0 then 'office' when 1 then 'hospital' else 'etc' end as dataset_industry, p_partkey % 3 = 1 as valid from part"""

_REASONS = """list_filter([case when least(width, height) < 720 then 'resolution_below_720px' end, case when text_area_ratio < 0.2 then 'text_area_below_20_percent' end,
    case when has_motion_blur then 'motion_blur_or_focus_failure' end, case when masked_text_ratio > 0.5 then 'masking_covers_over_50_percent_of_text' end,
    case when is_non_schedule_image then 'non_schedule_image' end, case when abs(tilt_degrees) > 30 then 'tilt_exceeds_30_degrees' end,
    case when legibility_ratio < 0.8 then 'legibility_below_80_percent' end, case when round_even(file_size_bytes / 1024.0, 2) < 100 then 'file_size_below_100kb' end,
    case when file_size_bytes > 20971520 then 'file_size_above_20mb' end], lambda x: x is not null)"""
_Q["qa_reasons"] = f"select doc_id, len(r) = 0 as passed, array_to_string(r, '|') as reasons from (select doc_id, {_REASONS} as r from quality_snapshots)"
_Q["qa_duplicates"] = "select doc_id, file_md5, first from (select doc_id, file_md5, min(doc_id) over (partition by file_md5) as first from quality_snapshots) where doc_id <> first"
_Q["qa_dataset_checks"] = """with x as (select *, min(doc_id) over (partition by file_md5) as f from images), r as (
      select 'duplicate_image' as issue_code from x where f <> doc_id union all select 'resolution_below_720px' from x where least(width, height) < 720
      union all select 'empty_detection_label' from x where detection_boxes = 0
      union all select 'synthetic_ratio_exceeds_50_percent' from (select avg(cast(source = 'synthetic' as int)) as v from images) where v > 0.5)
    select issue_code, count(*) as count from r group by 1"""
_Q["ds_stats"] = """select count(*) as total, count(*) filter (source = 'synthetic') as synthetic, count(*) filter (source <> 'synthetic') as "real",
    round(count(*) filter (source = 'synthetic') / cast(count(*) as double), 6) as synthetic_ratio, count(*) filter (difficult) as difficult, cast(sum(detection_boxes) as bigint) as detection_boxes, round(cast(sum(detection_boxes) as double) / count(*), 6) as mean_boxes from images"""
_Q["ds_distribution"] = "select key, coalesce(c, 0) as count, round(coalesce(c, 0) / cast((select count(*) from images) as double), 6) as ratio from (values ('en'), ('fr'), ('de'), ('it')) k(key) left join (select format as key, count(*) as c from images group by 1) using (key)"
_SPLIT = """a as (select *, source <> 'synthetic' as r, md5(concat('42|', cast(doc_id as varchar))) as h, count(*) filter (source <> 'synthetic') over (partition by format) as n from images),
    b as (select *, r and not difficult and row_number() over (partition by format, r, difficult order by h, doc_id) <= floor(n * 0.15) as t from a),
    c as (select *, r and not t and row_number() over (partition by format, r, t order by h, doc_id) <= floor(n * 0.15) as v from b),
    sp as (select *, case when t then 'test' when v then 'val' else 'train' end as split from c)"""
_Q["ds_split"] = f"with {_SPLIT} select doc_id, split from sp"
_Q["ds_split_validate"] = f"""with {_SPLIT}, i as (
      select 'synthetic_found_in_' || split as issue from sp where split <> 'train' and source = 'synthetic' union all
      select 'difficult_found_in_test' from sp where split = 'test' and difficult union all
      select 'filename_overlap_' || a.split || '_' || b.split from sp a join sp b on a.filename = b.filename and (a.split, b.split) in (('test', 'train'), ('test', 'val'), ('train', 'val'))),
    m as (select k.split, k.images, k.boxes, coalesce(n, 0) as n, coalesce(b, 0) as b from (values ('train', 700, 5000), ('val', 100, 700), ('test', 100, 700)) k(split, images, boxes)
      left join (select split, count(*) as n, cast(sum(detection_boxes) as bigint) as b from sp group by 1) using (split))
    select issue, count(*) as count from i group by 1 union all select split || '_image_count_below_minimum', n from m where n < images union all select split || '_det_boxes_below_minimum', b from m where b < boxes"""
_POS = "select doc_id, case when i < floor(n * {a}) then 'train' when i < floor(n * {a}) + floor(n * {b}) then 'val' else 'test' end as split from (select doc_id, row_number() over (order by doc_id) - 1 as i, count(*) over () as n from images)"
_Q["ds_positional_split"] = _POS.format(a="0.8::double", b="0.1::double")
_Q["ds_angle_pairs"] = f"select split, angle, count(*) as count from ({_POS.format(a='0.7::double', b='0.15::double')}), (values (0), (180)) v(angle) group by 1, 2"
_Q["ds_quota_gaps"] = "select key, required, actual, required - actual as missing from (select key, cast(required as bigint) as required, coalesce(c, 0) as actual from (values ('paper', 200), ('scan', 100), ('screen', 150), ('excel', 100), ('handwrite', 50)) k(key, required) left join (select format as key, count(*) as c from image_meta group by 1) using (key)) where actual < required"
_Q["synth_plan"] = "select industry, n as real_count, cast(case when n = 0 then 80 when n < 50 then 25 else 0 end as bigint) as recommended_render, cast(case when n = 0 then 0 when n < 50 then 25 else least(3 * n, 200) end as bigint) as recommended_aug from (select industry, count(*) as n from image_meta group by 1)"
_Q["label_prefix_join"] = """select filename, string_agg(crop_name, '|' order by crop_name, crop_text) as crop_names, string_agg(crop_text, '|' order by crop_name, crop_text) as crop_texts
    from (select concat('doc_', cast(doc_id as varchar), '.png') as filename, concat('doc_', cast(doc_id as varchar)) as stem from documents) i join crops c on starts_with(c.crop_name, i.stem || '_') group by 1"""

_CELLS = """cells as (select g.image_id, g.worker, g.day, g.gt_code, coalesce(p.pred_code, '') as pred_code, m.format, m.industry, m.parse_success,
      case when coalesce(p.pred_code, '') = g.gt_code then null when not m.parse_success then 'parse_error' when coalesce(p.pred_code, '') = '' then 'det_miss' else 'rec_error' end as error_type
    from schedule_gt g left join schedule_pred p using (image_id, worker, day) left join schedule_meta m using (image_id))"""
_DIST = """dist as (select image_id, case when sum(g) = 0 then 0.0 else cast(sum(abs(g - p)) as double) / sum(g) end as code_distribution_error from (
      select image_id, code, sum(g) as g, sum(p) as p from (select image_id, gt_code as code, 1 as g, 0 as p from schedule_gt where gt_code <> '' union all select image_id, pred_code, 0, 1 from schedule_pred where pred_code <> '') group by 1, 2) group by 1)"""
_RES = f"""with {_CELLS}, {_DIST}, per as (select c.image_id, c.worker, count(*) as total, count(*) filter (error_type is null) as good, max(case when n.worker is not null then 1 else 0 end) as named
      from cells c left join (select distinct image_id, worker from schedule_pred) n on n.image_id = c.image_id and n.worker = c.worker group by 1, 2),
    res as (select p.image_id, m.parse_success, m.format, m.industry, cast(sum(total) as bigint) as total_cells, cast(sum(good) as bigint) as correct_cells, cast(sum(good) as double) / sum(total) as cell_accuracy,
      cast(count(*) filter (total = good) as double) / count(*) as worker_schedule_accuracy, cast(sum(named) as double) / count(*) as name_accuracy, coalesce(any_value(d.code_distribution_error), 0.0) as code_distribution_error, cast(sum(total) - sum(good) as bigint) as error_count
      from per p left join dist d using (image_id) left join schedule_meta m using (image_id) group by 1, 2, 3, 4)"""
_FOUR = ("cell_accuracy", "worker_schedule_accuracy", "name_accuracy", "code_distribution_error")
_MEANS = "count(*) as total_images, round(cast(count(*) filter (parse_success) as double) / count(*), 6) as parse_success_rate, " + ", ".join(f"round(coalesce(avg({m}) filter (parse_success), 0.0), 6) as {m}" for m in _FOUR)
_MET = "cell_accuracy >= 0.9 and worker_schedule_accuracy >= 0.7 and name_accuracy >= 0.85 and code_distribution_error <= 0.05 as targets_met"
_Q["e2e_cells"] = f"with {_CELLS} select image_id, worker, day, gt_code, pred_code, error_type from cells"
_Q["e2e_per_image"] = f"{_RES} select image_id, parse_success, format, industry, total_cells, correct_cells, {', '.join(f'round({m}, 6) as {m}' for m in _FOUR)}, error_count from res"
_Q["e2e_summary"] = f"{_RES} select *, {_MET} from (select {_MEANS} from res)"
_Q["e2e_by_format"] = f"""{_RES}, kinds as (select format, error_type, row_number() over (partition by format order by count(*) desc, error_type) as rn from cells where error_type is not null group by 1, 2)
    select r.*, {_MET}, k.error_type as main_error_type from (select format, {_MEANS} from res group by 1) r left join (select * from kinds where rn = 1) k using (format)"""
_Q["e2e_error_attribution"] = f"with {_CELLS} select error_type, count(*) as count, round(cast(count(*) as double) / sum(count(*)) over (), 6) as ratio from cells where error_type is not null group by 1"
_Q["e2e_code_distribution"] = f"with {_DIST} select image_id, round(code_distribution_error, 6) as code_distribution_error from dist"


def _cluster(axis: str) -> str:
    a, b = ("y1", "y2") if axis == "y" else ("x1", "x2")
    return f"""{axis}o as (select image_id, seq, ({a} + {b}) / 2.0 as c, cast(greatest(1, {b} - {a}) as double) as s, row_number() over (partition by image_id order by ({a} + {b}) / 2.0, seq) as rn from tokens),
    {axis}w as (select image_id, seq, rn, 0 as cluster, cast(1 as double) as n, c as sc, s as ss from {axis}o where rn = 1 union all
      select o.image_id, o.seq, o.rn, case when abs(o.c - w.sc / w.n) <= w.ss / w.n * 0.5 then w.cluster else w.cluster + 1 end,
        case when abs(o.c - w.sc / w.n) <= w.ss / w.n * 0.5 then w.n + 1 else 1 end, case when abs(o.c - w.sc / w.n) <= w.ss / w.n * 0.5 then w.sc + o.c else o.c end,
        case when abs(o.c - w.sc / w.n) <= w.ss / w.n * 0.5 then w.ss + o.s else o.s end
      from {axis}w w join {axis}o o on o.image_id = w.image_id and o.rn = w.rn + 1)"""


_HEAD = """sh as (select image_id, w.cluster as row, cast(count(*) filter (regexp_full_match(text, '0*([1-9]|[12][0-9]|3[01])')) as double) / count(*) as share from yw w join tokens t using (image_id, seq) group by 1, 2),
    head as (select image_id, case when share >= 0.5 then row else 0 end as header_row, share from (select *, row_number() over (partition by image_id order by share desc, row) as rn from sh) where rn = 1)"""
_NEAR = """cc as (select image_id, cluster, avg((x1 + x2) / 2.0) as c from xw join tokens using (image_id, seq) group by 1, 2),
    near as (select image_id, seq, cluster as col from (select t.image_id, t.seq, cc.cluster, row_number() over (partition by t.image_id, t.seq order by abs(cc.c - (t.x1 + t.x2) / 2.0), cc.cluster) as rn from tokens t join cc using (image_id)) where rn = 1)"""
_Q["tok_cluster_rows"] = f"with recursive {_cluster('y')} select image_id, seq, cluster from yw"
_Q["tok_header"] = f"with recursive {_cluster('y')}, {_HEAD} select image_id, header_row, round(share, 6) as numeric_ratio from head"
_Q["tok_nearest_column"] = f"with recursive {_cluster('x')}, {_NEAR} select image_id, seq, col as column from near"
_Q["tok_schedule"] = f"""with recursive {_cluster('y')}, {_cluster('x')}, {_HEAD}, {_NEAR},
    tk as (select t.*, w.cluster as row, h.header_row, n.col from tokens t join yw w using (image_id, seq) join head h using (image_id) join near n using (image_id, seq)),
    dt as (select image_id, list(text order by (x1 + x2) / 2.0, seq) as dates from tk where row = header_row and regexp_full_match(text, '0*([1-9]|[12][0-9]|3[01])') group by 1),
    bd as (select tk.*, dates, row_number() over (partition by tk.image_id, row order by (x1 + x2) / 2.0, seq) as place, first_value(text) over (partition by tk.image_id, row order by (x1 + x2) / 2.0, seq) as worker from tk join dt using (image_id) where row <> header_row),
    lr as (select *, max(row) over (partition by image_id, worker) as last_row from bd where worker <> ''),
    ok as (select * from lr where row = last_row),
    cl as (select image_id, worker, row, day, code from (select image_id, worker, row, dates[greatest(1, least(len(dates), col))] as day, text as code, row_number() over (partition by image_id, worker, row, dates[greatest(1, least(len(dates), col))] order by place desc) as rn from ok where place > 1) where rn = 1),
    gr as (select distinct image_id, worker, row, unnest(dates) as day from ok where place = 1)
    select g.image_id, g.worker, g.row as worker_pos, g.day, coalesce(c.code, '') as code from gr g left join cl c using (image_id, worker, row, day)"""

_VALUES = {
    "metrics.f1": ("0.80", "0.01"), "metrics.recall": ("0.79", "0.01"), "metrics.precision": ("0.85", "0.01"), "metrics.cer": ("0.03", "0.001"), "metrics.wer": ("0.05", "0.001"),
    "domain_metrics.work_code_accuracy": ("0.93", "0.002"), "domain_metrics.date_exact_match": ("0.9", "0.002"), "metrics.false_positive_rate": ("0.0", "0.001"),
    "metrics.cell_accuracy": ("0.87", "0.005"), "metrics.worker_schedule_accuracy": ("0.7", "0.0"), "metrics.name_accuracy": ("0.9", "0.0"), "metrics.code_distribution_error": ("0.02", "0.0"),
    "parse_success_rate": ("0.95", "0.0"), "speed.cpu_p50_seconds": ("2.0", "0.2"), "memory.model_loaded_gb": ("1.0", "0.0"), "memory.peak_inference_gb": ("2.0", "0.0"), "stability.exceptions_per_100": ("0.0", "0.0"),
}


def _rules() -> str:
    rows = []
    for pos, (gate, section, name, path, threshold, op, required, default) in enumerate(CRITERIA):
        base, step = ("0.9", "0.001") if (section, path) == ("recognition", "metrics.accuracy") else ("0.98", "0.001") if (section, path) == ("classifier", "metrics.accuracy") else _VALUES.get(path, (str(default), "0.0"))
        rows.append(f"({pos}, {gate}, '{section}', '{name}', {base}::double, {step}::double, {threshold}::double, '{op}', {str(required).lower()})")
    return ", ".join(rows)


_GATE = f"""ev as (select s_suppkey as run, pos, gate, section, name, round(base + (s_suppkey % 10) * step, 4) as value, threshold, op, required
      from supplier, (values {_rules()}) r(pos, gate, section, name, base, step, threshold, op, required)),
    ep as (select *, case when op = '>=' then value >= threshold else value <= threshold end as passed from ev),
    sec as (select run, gate, section, coalesce(bool_and(passed) filter (required), true) as passed, coalesce(bool_or(not passed) filter (not required), false) as soft, coalesce(string_agg(name, '|' order by pos) filter (required and not passed), '') as failed_items from ep group by 1, 2, 3)"""
_Q["gate_eval"] = f"with {_GATE} select run, gate, section, name, value, threshold, op, required, passed from ep"
_Q["gate_sections"] = f"with {_GATE} select run, gate, section, passed, passed and soft as conditional, failed_items from sec"
_ACT = " ".join(f"when '{k}' then '{v}'" for k, v in ACTIONS.items())
_Q["gate_status"] = f"""with {_GATE}, g as (select run, gate, bool_and(passed) as p from sec group by 1, 2),
    w as (select run, bool_and(p) filter (gate = 1) as g1, bool_and(p) filter (gate <= 2) as g2, bool_and(p) as g3 from g group by 1),
    f as (select s.run, s.gate, s.section from sec s join w using (run) where not s.passed and (s.gate = 1 or (s.gate = 2 and g1) or (s.gate = 3 and g2)))
    select w.run, case when g3 then 'PASS' when g2 then 'CONDITIONAL_PASS' else 'FAIL' end as status, coalesce((select string_agg(case section {_ACT} end, '|' order by gate, section) from f where f.run = w.run), '') as actions from w"""

_LEVEL = "case when confidence >= 0.9 then 'high' when confidence < 0.7 then 'low' else 'mid' end"
_USABLE = "original_text <> corrected_text and length(corrected_text) between 1 and 20 and crop_saved"
_Q["conf_levels"] = f"select event_id, {_LEVEL} as level from feedback"
_Q["conf_enrich"] = f"select event_id, round_even(confidence, 4) as confidence, {_LEVEL} as confidence_level, concat(import_id, '_cell', lpad(cast(event_id % 40 + 1 as varchar), 3, '0')) as cell_id from (select event_id, import_id, confidence / 3 as confidence from feedback)"
_Q["conf_summary"] = f"select import_id, count(*) as total, count(*) filter (l = 'high') as high, count(*) filter (l = 'mid') as mid, count(*) filter (l = 'low') as low, count(*) filter (l <> 'high') as review_required from (select import_id, {_LEVEL} as l from feedback) group by 1"
_Q["fb_usable"] = f"select event_id, {_USABLE} and regexp_full_match(corrected_text, '[a-pr-z1]*') as usable from feedback"
_Q["fb_stats"] = f"select count(*) as total, count(*) filter ({_USABLE}) as usable, count(*) filter ({_LEVEL} = 'high') as high, count(*) filter ({_LEVEL} = 'mid') as mid, count(*) filter ({_LEVEL} = 'low') as low, left(cast(max(ts) as varchar), 10) as last_date, count(*) filter ({_USABLE}) >= 100 as ready from feedback"
_Q["fb_top_corrections"] = "select * from (select original_text, corrected_text, count(*) as count from feedback group by 1, 2 order by 3 desc, 1, 2 limit 10) where original_text <> corrected_text"
_Q["fb_ids"] = "select event_id, concat('fb_', lpad(cast(row_number() over (order by event_id) as varchar), 6, '0')) as feedback_id from feedback"
_Q["fb_training_set"] = f"""select case when event_id % 2 = 0 then concat('crops/', cast(event_id as varchar), '.png') else concat('fallback/fb_', lpad(cast(event_id as varchar), 6, '0'), '.png') end as crop_path, corrected_text as text
    from feedback where {_USABLE} and (event_id % 2 = 0 or event_id % 7 = 0) and (select count(*) from feedback where {_USABLE}) >= 50"""
_Q["rollback_triggers"] = """select k, array_to_string(list_filter([case when e > 0.05 and e >= p * 3 then 'error_rate_exceeded' end, case when k % 13 >= 10 then 'consecutive_exceptions' end, case when m > 4.0 then 'memory_limit_exceeded' end, case when k % 9 = 0 then 'health_check_failed' end], lambda x: x is not null), '|') as triggers
    from (select s_suppkey as k, cast(s_suppkey * 7 % 100 as double) / 1000.0 as e, cast(s_suppkey * 3 % 100 as double) / 1000.0 as p, cast(s_suppkey * 11 % 100 as double) / 20.0 as m from supplier)"""
_Q["reg_upsert"] = "select version, case when status = 'deprecated' then 'active' else status end as status, case when status = 'deprecated' then 1.0 else score end as score from versions"
_Q["reg_deploy"] = "select version, case when version = 'v1.1.0' then 'active' when status = 'active' then 'superseded' else status end as status from versions"
_Q["reg_active"] = "select min(version) as active_version from versions where status = 'active'"
_Q["reg_history"] = "select seq, version, status from versions order by seq desc limit 20"
_CH = "select unnest(string_split(text, '')) as ch from documents"
_Q["charset_freq"] = f"select ch, count(*) as count from ({_CH}) where ch <> '' group by 1"
_BASE = ", ".join("('" + c.replace("'", "''") + "')" for c in dict.fromkeys(JAMO + "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + PUNCTUATION + "".join(CODES.values()).replace(" ", "")))
_ALL = f"chars as (select distinct ch from (select chr(cast(i as int)) as ch from range(44032, 55204) t(i) union all select ch from (values {_BASE}) v(ch)))"
_Q["charset_missing"] = f"with {_ALL} select ch, count from (select ch, count(*) as count from ({_CH}) where ch <> '' group by 1) f anti join chars using (ch)"
_Q["charset_size"] = f"with {_ALL} select count(*) as size, count(*) filter (unicode(ch) between 44032 and 55203) as hangul, count(*) filter (ch in (select ch from ({_CH}))) as used from chars"
_Q["encode_text"] = "select p_partkey, array_to_string(list_transform(string_split(p_name, ''), lambda c: case when strpos('abcdefghijklmnopqrstuvwxyz 0123456789', c) > 0 then strpos('abcdefghijklmnopqrstuvwxyz 0123456789', c) - 1 else 99 end), ',') as ids from part"
_Q["ctc_greedy"] = """with l as (select sample, (i - 1) // 8 as t, (i - 1) % 8 as v, cast(embedding[i] as double) as x from (select vec_id as sample, embedding, unnest(range(1, 65)) as i from embeddings)),
    s as (select sample, t, arg_max(v, (x, -v)) as idx, 1.0 / sum(exp(x - m)) as p from (select *, max(x) over (partition by sample, t) as m from l) group by 1, 2),
    k as (select *, idx <> 7 and (lag(idx) over (partition by sample order by t) is null or lag(idx) over (partition by sample order by t) <> idx) as keep from s)
    select sample, coalesce(string_agg(substr('ABCDEFG', cast(idx + 1 as int), 1), '' order by t) filter (keep), '') as text, round(coalesce(avg(p) filter (keep), 0.0), 6) as score from k group by 1"""
_Q["ckpt_best"] = "select run_id, step, coalesce(loss_total < min(loss_total) over (partition by run_id order by step rows between unbounded preceding and 1 preceding), true) as is_best from train_log"
_Q["ckpt_keep_last"] = "select run_id, step from (select *, row_number() over (partition by run_id order by step desc) as k from train_log) where k <= 3"
_Q["health_diverging"] = """with u as (select *, case when loss_total > lag(loss_total) over (partition by run_id order by step) then 1 else 0 end as up from train_log),
    h as (select *, sum(up) over (partition by run_id order by step rows between 2 preceding and current row) as ups from u)
    select run_id, step, issues from (select run_id, step, array_to_string(list_filter([case when isnan(loss_total) then 'loss_nan' end, case when ups = 3 and not isnan(loss_total) then 'loss_diverging' end, case when not isnan(grad_norm) and grad_norm > 1000 then 'grad_norm_spike' end], lambda x: x is not null), '|') as issues from h) where issues <> ''"""
_Q["latency_pctl"] = "select event_type, len(v) as n, v[cast(floor((len(v) - 1) * 0.5::double) as int) + 1] as p50, v[cast(floor((len(v) - 1) * 0.95::double) as int) + 1] as p95, v[cast(floor((len(v) - 1) * 0.99::double) as int) + 1] as p99, round(m, 6) as mean, v[len(v)] as max from (select event_type, list(value order by value) as v, avg(value) as m from events group by 1)"


def _budget() -> str:
    """A fold by hand: one nested query for each augmentation."""
    sql = "select doc_id, 0 as s, '' as applied from documents"
    for (name, chance, strength), m in zip(AUGMENTATIONS, (3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)):
        cost = int(round(strength * 1000))
        take = f"(cast((doc_id * {m}) % 97 as double) / 97.0) * 1000000 <= {int(round(chance * 1_000_000))} and s + {cost} <= 650"
        sql = f"select doc_id, case when {take} then s + {cost} else s end as s, case when {take} then applied || '|{name}' else applied end as applied from ({sql})"
    return f"select doc_id, ltrim(applied, '|') as applied from ({sql})"


_Q["aug_budget"] = _budget()
_Q["global_rank"] = "select o_orderkey, row_number() over (order by o_orderkey) as rank from orders"

_Q |= files.SQL | images.SQL | training_sets.SQL | streams.SQL | rules.SQL

ORACLES: dict[str, str] = {name: duck(sql.replace("as string)", "as varchar)")) for name, sql in _Q.items()}
