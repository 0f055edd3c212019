"""DuckDB SQL for those corpus queries that SQL can express."""

from __future__ import annotations

from scrivena.llm.weak_rules import FUNCTION_WORDS, HIGH, KEEP, LEAST_WORDS, LOW, MOST_REPEATED, ROUNDS

_WORDS = r"coalesce(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'), [])"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: A row for each node of links(a, b), with the least node that it reaches.
_REACH = """reach as (select a as x, b as y from links union select b, a from links
      union select r.x, l.b from reach r join (select a, b from links union all select b, a from links) l on r.y = l.a),
    low as (select x, least(x, min(y)) as component_id from reach group by x)"""

_CAPTURES = """p as (select page_id as p, url, html, md5(coalesce(html, '')) as tag, 'day ' || cast(page_id % 365 as varchar) as stamp, page_id * 7919 % 100000 as ts, page_id % 4 <> 0 as by_tag from pages where page_id is not null),
    resp as (select p * 3 as response_id, url, ts, tag, stamp, by_tag, html, 't ' || cast(ts as varchar) as date from p where p % 7 <> 0),
    asks as (select p * 3 + 1 as record_id, url, ts + 10 + p % 50 as ts, case when by_tag then 'W/' || tag end as etag, case when not by_tag then stamp end as modified, 'max-age=120' as cache, null as expires from p
      union all select p * 3 + 2, url, ts + 5000 + p % 3000, case when p % 5 = 0 then 'other' when by_tag then tag end, null, null, 't ' || cast(ts + 5000 + p % 3000 + 60 as varchar) from p)"""


def _canonical(table: str) -> str:
    return f"""select * exclude (u, host, path, q), host || path || case when len(q) > 0 then '?' || array_to_string(q, '&') else '' end as canonical_url from (
      select *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '') as host,
        regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') as path,
        list_sort(list_filter(string_split(regexp_extract(u, '[?](.*)$', 1), '&'), lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) as q
      from (select *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') as u from {table}))"""


def _posterior(votes: str) -> str:
    up, down = "ln(em.good[j] / (1 - em.bad[j]))", "ln((1 - em.good[j]) / em.bad[j])"
    return f"(1 / (1 + exp(-(ln(em.prior / (1 - em.prior)) + list_sum(list_transform(range(1, 11), lambda j: case {votes}[j] when 1 then {up} when -1 then {down} else 0.0::double end))))))"


def _inside(value: str, low: float, high: float) -> str:
    return f"least(greatest({value}, {low}::double), {high}::double)"


def _accuracy(share: str, vote: int) -> str:
    right, all_ = (f"list_sum(list_transform(s, lambda x: case when x.v[j] {test} then {share} else 0.0::double end))" for test in (f"= {vote}", "<> 0"))
    return f"list_transform(range(1, 11), lambda j: {_inside(f'({right} + 1) / ({all_} + 2)', LOW, HIGH)})"


ORACLE_SQL: dict[str, str] = {
    "op1_revisit_resolution": f"""with {_CAPTURES}, r as ({_canonical('resp')}), a as ({_canonical('asks')}),
    r1 as (select * from r qualify row_number() over (partition by canonical_url, ts order by response_id desc) = 1),
    j as (select a.record_id, a.canonical_url, a.ts, a.etag, a.modified, a.cache, a.expires, r1.response_id, r1.html, r1.by_tag, r1.tag, r1.stamp
      from a asof left join r1 on a.canonical_url = r1.canonical_url and a.ts > r1.ts),
    s as (select *, case when response_id is null then 'no_response'
        when etag is not null and by_tag then case when regexp_replace(etag, '^W/', '') = tag then 'resolved' else 'mismatch' end
        when modified is not null then case when modified = stamp then 'resolved' else 'mismatch' end else 'unvalidated' end as status from j)
    select record_id, canonical_url, ts, status, response_id,
      case when status = 'resolved' then array_to_string(list_filter(['cache-control: ' || coalesce(cache, 'max-age=60'), 'content-length: ' || cast(strlen(coalesce(html, '')) as varchar), 'content-type: text/html',
        'date: t ' || cast(ts as varchar), 'etag: ' || coalesce(etag, case when by_tag then tag end),
        'expires: ' || expires, 'last-modified: ' || coalesce(modified, stamp)], lambda x: x is not null), chr(10)) end as headers,
      case when status = 'resolved' then md5(html) end as payload_md5
    from s""",
    "op2_fm_index_dedup": f"""with w as (select doc_id, {_WORDS.format(text='text')} as ws from documents where doc_id is not null),
    g as (select doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) as k from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w)),
    m as (select k, min(doc_id) as d from g group by k),
    gone as (select distinct doc_id, j from (select g.doc_id, unnest(range(g.i, g.i + 50)) as j from g join m using (k) where m.d < g.doc_id)),
    one as (select doc_id, ws[j] as word, j from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as j from w)),
    kept as (select doc_id, string_agg(word, ' ' order by j) as kept from one anti join gone using (doc_id, j) group by doc_id)
    select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n.n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
    from w left join (select doc_id, count(*) as n from gone group by 1) n using (doc_id) left join kept using (doc_id)""",
    "op6_token_combination_join": f"""with recursive w as (select doc_id, {_WORDS.format(text=_LOWER)} as ws from documents where doc_id is not null),
    s as (select distinct doc_id, array_to_string(ws[i : i + 2], ' ') as t from (select doc_id, ws, unnest(case when len(ws) = 0 then [] when len(ws) < 3 then [1] else range(1, len(ws) - 1) end) as i from w)),
    n as (select doc_id, count(*) as n from s group by 1),
    links as (select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.t = y.t and x.doc_id < y.doc_id group by 1, 2) p
      join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 90 * (na.n + nb.n - c)), {_REACH}
    select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(low.component_id, w.doc_id) as component_id from w left join n using (doc_id) left join low on low.x = w.doc_id""",
    "op9_embedding_dedup": f"""with recursive v as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings where vec_id is not null),
    ok as (select * from v where label is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
    links as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id < b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.98), {_REACH},
    n as (select x, count(*) as n from (select a as x from links union all select b from links) group by 1)
    select v.vec_id, coalesce(n.n, 0) as n_links, coalesce(low.component_id, v.vec_id) as component_id, coalesce(low.component_id, v.vec_id) = v.vec_id as kept from v left join n on n.x = v.vec_id left join low on low.x = v.vec_id""",
    "op11_source_divergence": rf"""with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all({_LOWER.replace("(text,", "(coalesce(text, ''),")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as ts from documents),
    o as (select r, lang, source, unnest(ts) as t from d),
    k as (select lang, t, count(*) as n from o group by 1, 2 having count(distinct r) >= 3),
    v as (select lang, count(*) as v, sum(n) as n from k group by 1),
    c as (select lang, source, t, count(*) as n from o semi join k using (lang, t) group by all),
    g as (select g.lang, g.source, coalesce(any_value(v.v), 0) as v, coalesce(sum(c.n), 0) as n from (select distinct lang, source from d) g left join v using (lang) left join c on c.lang = g.lang and c.source = g.source group by 1, 2),
    p as (select g.lang, g.source, k.t, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.n + g.v) as p from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.t = k.t),
    l as (select lang, t, 1 + (1000000000::hugeint * (k.n + 1)) // (v.n + v.v) as q from k join v using (lang)),
    pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value from p a join p b on a.lang = b.lang and a.t = b.t and a.source <> b.source group by all),
    found as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(pairs.value, 0) as bigint) as value from g a join g b on a.lang = b.lang and a.source <> b.source left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
      union all select lang, source, 'term', t, cast((p - q) * (p - q) // q as bigint) from p join l using (lang, t) where n > 0 and p > q)
    select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank from found qualify part = 'pair' or rank <= 200""",
    "op12_prefix_trie": """with recursive bits(i, k, v) as (select cast(i as bigint), 0, cast(i as bigint) from range(256) r(i) union all select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
    tab as (select i, v from bits where k = 8),
    crc(c, s, k, v) as (select conv_id, cast(conv_id as varchar), 1, 4294967295 from (select distinct conv_id from conversations where conv_id is not null) union all
      select c, s, k + 1, xor(crc.v >> 8, tab.v) from crc join tab on tab.i = xor(crc.v, ascii(s[k])) & 255 where k <= len(s)),
    convs as (select c, c - c % 5 as base, xor(v, 4294967295) % 9 as h from crc where k = len(s) + 1),
    t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, x) - 1 as pos, x, bytes from (
      select conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as x, strlen(coalesce(text, '')) as bytes from conversations where conv_id is not null)),
    r as (select c, row_number() over (partition by c order by own, pos) as d, x, bytes from (
      select convs.c, false as own, pos, x, bytes from convs join t on t.c = base where pos < h union all select c, true, pos, x, bytes from convs join t using (c) where pos >= h)),
    l as (select c, list(x order by d) as xs from r group by 1),
    m as (select c, d, md5(array_to_string(xs[:d], ',')) as k, bytes, len(xs) = d as stop from r join l using (c) union all select c, 0, '', 0, xs is null from convs left join l using (c)),
    n as (select d, k, min(c) as rep, count(*) as n, any_value(bytes) as bytes, bool_and(stop) as leaf, sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where stop), '')) as ends from m group by 1, 2),
    sub as (select m.d, m.k, sum(cast(v.leaf as int)) as leaves, sum((v.n - 1) * v.bytes) as saved from m join n v on v.rep = m.c and v.d >= m.d group by 1, 2),
    up as (select n.d, n.k, p.k as pk, p.rep as parent from n join m on m.c = n.rep and m.d = n.d - 1 join n p on p.d = m.d and p.k = m.k),
    kids as (select d - 1 as d, pk as k, count(*) as n from up group by 1, 2)
    select n.rep as conv_id, n.d as depth, parent as parent_conv_id, n.n as n_convs, coalesce(kids.n, 0) as n_children, cast(leaves as bigint) as n_leaves, cast(saved as bigint) as saved_tokens, ends as ends_sha256
    from n join sub using (d, k) left join up using (d, k) left join kids using (d, k)""",
    "op13_weak_rules": rf"""with recursive w as (select row_number() over () as r, doc_id, coalesce(text, '') as t, {_WORDS.format(text='text')} as ws from documents where doc_id is not null),
    l as (select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from w),
    g as (select r, i, array_to_string(ws[i : i + 2], ' ') as k from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w)),
    rep as (select r, count(distinct j) as n from (select r, unnest(range(i, i + 3)) as j from g where (r, k) in (select r, k from g group by 1, 2 having count(*) > 1)) group by r),
    f as (select l.r, doc_id, cast(len(ws) as bigint) as n, cast(len(array_to_string(ws, '')) as bigint) as chars, cast(len(t) - len(translate(t, '#*$%&|<>', '')) as bigint) as sym,
        cast(len(ls) - len(list_distinct(ls)) as bigint) as dup, coalesce(rep.n, 0) as rep, len(ls) as nl, len(regexp_replace(t, '\P{{L}}+', '', 'g')) as let, len(list_distinct(ws)) as dis,
        len(list_filter(ws, lambda x: regexp_matches(x, '^["''(\[]?\p{{L}}+(?:[-''\x{{2019}}]\p{{L}}+)*[.,;:!?)\]"'']?$'))) as plain, len(list_filter(ws, lambda x: regexp_matches(x, '[^\p{{L}}\p{{N}}]{{2}}$'))) as dou,
        len(list_filter(ws, lambda x: len(x) > 1 and regexp_matches(x, '^\P{{Ll}}*\p{{Lu}}\P{{Ll}}*$'))) as up, len(list_filter(ws, lambda x: lower(x) in ({", ".join(f"'{x}'" for x in FUNCTION_WORDS)}))) as fun,
        len(list_filter(ls, lambda x: regexp_matches(x, '[.!?]["'')\]]*\s*$'))) as ended from l left join rep using (r)),
    v as (select *, n < {LEAST_WORDS} or 100 * rep > {MOST_REPEATED} * n as bad, [{", ".join(f"case when {no} then -1 when {yes} and n > 0 then 1 else 0 end" for no, yes in (
        ("100 * sym > 10 * n", "100 * sym <= 2 * n"), ("100 * plain <= 70 * n", "100 * plain > 95 * n"), ("100 * fun <= 8 * n", "100 * fun > 12 * n"), ("100 * let <= 80 * chars", "100 * let > 90 * chars"),
        ("100 * dou > 10 * n", "100 * dou <= 2 * n"), ("100 * up > 30 * n", "100 * up <= 10 * n"), ("100 * rep > 20 * n", "100 * rep <= 5 * n"), ("100 * dis <= 15 * n", "100 * dis > 35 * n"),
        ("100 * dup > 30 * nl", "dup = 0 and nl >= 2"), ("100 * ended <= 10 * nl and nl >= 4", "100 * ended > 60 * nl")))}] as votes from f),
    p as (select list({{'v': votes, 'n': c}} order by votes) as p from (select votes, count(*) as c from v where not bad group by 1)),
    em as (select 0 as i, 0.7::double as prior, list_transform(range(10), lambda x: 0.8::double) as good, list_transform(range(10), lambda x: 0.8::double) as bad union all
      select i + 1, {_inside("(list_sum(list_transform(s, lambda x: x.n * x.q)) + 1) / (list_sum(list_transform(s, lambda x: cast(x.n as double))) + 2)", 0.01, 0.99)},
        {_accuracy("x.n * x.q", 1)}, {_accuracy("x.n * (1 - x.q)", -1)}
      from (select em.i, list_transform(p.p, lambda x: {{'v': x.v, 'n': x.n, 'q': {_posterior('x.v')}}}) as s from em, p where em.i < {ROUNDS} and p.p is not null))
    select doc_id, n as n_words, chars as word_chars, sym as n_symbols, dup as n_dup_lines, rep as n_repeat_words, v.bad as base_failed, not v.bad and {_posterior('v.votes')} >= {KEEP} as kept,
      array_to_string(v.votes, ',') as votes, round({_posterior('v.votes')}, 6) as quality from v, (select * from em order by i desc limit 1) em""",
}
