"""DuckDB SQL for the queries whose rows SQL can express."""

from __future__ import annotations

from quarry.llm import centroids, fim, mixing, url_filter
from quarry.llm.decontaminate import WINDOW


def url_sql() -> str:
    upper, lower = url_filter.UPPER, url_filter.LOWER
    fits = lambda h, p: f"((host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}'))"
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"when {fits(h, p)} then '{h}{p}'" for _, h, p in rules)
    verdict = " ".join(f"when {fits(h, p)} then '{v}'" for v, h, p in rules)
    listed = " or ".join(f"contains(host, '{w}')" for w in url_filter.LISTED_WORDS)
    pattern = "^.*?://([^/?#]*)([^?#]*)"
    return f"""
    with split as (
      select page_id, translate(regexp_extract(coalesce(url, ''), '{pattern}', 1, 's'), '{upper}', '{lower}') host,
             regexp_extract(coalesce(url, ''), '{pattern}', 2, 's') path from pages)
    select page_id, host, path, case {rule} end as rule,
           case {verdict} when {listed} then 'block' else 'allow' end as verdict from split"""


def mix_sql() -> str:
    m = mixing
    noise = " or ".join(f"contains(body, '{x}')" for x in m.NOISE)
    parts = [
        f"""words as (
      select doc_id, coalesce(source, '') source, coalesce(lang, '') lang, coalesce(text, '') body,
             len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+'))::bigint tokens from documents)""",
        f"""doc as (
      select doc_id, source, lang, tokens,
             case when contains(body, ' | ') then 'table' when {noise} then 'noise' when tokens < 100 then 'note'
                  when tokens >= 1000 then 'long' else 'prose' end topic from words)""",
        "cells as (select source, lang, topic, sum(tokens)::double tokens from doc group by all)",
    ]
    for g in m.MARGINS:
        parts.append(
            f"""aim_{g} as (
      select {g}, pow(have, {m.POWER}) / sum(pow(have, {m.POWER})) over () * sum(have) over () aim
      from (select {g}, sum(tokens) have from cells group by {g}))"""
        )
    at = "(select *, tokens weight from cells)"
    for r in range(m.ROUNDS):
        for g in m.MARGINS:
            name = f"fit_{r}_{g}"
            parts.append(
                f"""{name} as materialized (
      select f.source, f.lang, f.topic, f.tokens, f.weight * coalesce(a.aim / nullif(s.now, 0), 1.0) weight
      from {at} f join aim_{g} a using ({g}) join (select {g}, sum(weight) now from {at} group by {g}) s using ({g}))"""
            )
            at = name
    parts.append(f"ratio as materialized (select *, coalesce(weight / nullif(tokens, 0), 0.0) ratio from {at})")
    parts.append(f"factor_0 as (select {m.RATE}::double f)")
    for r in range(m.CAP_ROUNDS):
        parts.append(
            f"""sums_{r} as materialized (
      select f, coalesce(sum(tokens) filter (ratio * f >= 1), 0.0) full_, coalesce(sum(weight) filter (ratio * f < 1), 0.0) rest,
             sum(tokens) * {m.RATE} goal from ratio, factor_{r} group by f)"""
        )
        parts.append(
            f"""factor_{r + 1} as materialized (
      select case when rest <= 0 or goal <= full_ then f else greatest(f, (goal - full_) / rest) end f from sums_{r})"""
        )
    chance = f"('0x' || substr(md5(doc_id::varchar || ':{m.SEED}'), 1, 13))::bigint / {float(1 << 52)}"
    return f"""with {", ".join(parts)}
    select doc_id, source, lang, topic, tokens, round(ratio, 6) weight, round(least(1.0, ratio * f), 6) probability,
           {chance} < least(1.0, ratio * f) kept
    from doc join (select source, lang, topic, ratio from ratio) using (source, lang, topic), factor_{m.CAP_ROUNDS}"""


def contamination_sql() -> str:
    upper, lower = url_filter.UPPER, url_filter.LOWER
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
    with b as (select item_id::varchar item, {words} w from benchmark),
    pattern as (select distinct item, least(len(w), {WINDOW}) size, array_to_string(w[i:i + {WINDOW - 1}], ' ') said
                from (select *, unnest(range(1, greatest(2, len(w) - {WINDOW - 2}))) i from b where len(w) > 0)),
    d as (select doc_id, {words} w from documents),
    place as (select doc_id, size, unnest(range(1, len(w) - size + 2)) i, w from d, (select distinct size from pattern) where len(w) >= size),
    found as (select doc_id, i, size, item from place join pattern using (size) where array_to_string(w[i:i + size - 1], ' ') = said),
    hits as (select doc_id, count(distinct j) n from (select doc_id, unnest(range(i, i + size)) j from found) group by doc_id),
    items as (select doc_id, count(*) n, string_agg(item, ',' order by item) said from (select distinct doc_id, item from found) group by doc_id)
    select doc_id, len(w) n_words, coalesce(hits.n, 0) n_hit, coalesce(items.n, 0) n_items, sha256(coalesce(said, '')) items_sha256,
           coalesce(hits.n, 0) > 0 and 20 * coalesce(hits.n, 0) >= len(w) contaminated
    from d left join hits using (doc_id) left join items using (doc_id)"""


def groups_sql() -> str:
    upper, lower = url_filter.UPPER, url_filter.LOWER
    return f"""
    with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^ \\x09-\\x0D]+') w from documents),
    s as materialized (select distinct doc_id, array_to_string(w[i:i + 4], ' ') g from (select *, unnest(range(1, greatest(2, len(w) - 3))) i from d where len(w) > 0)),
    n as materialized (select doc_id, count(*) n from s group by doc_id),
    pair as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
    link as materialized (select a, b from pair join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
    reach as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a)
    select doc_id, coalesce(n, 0) n_shingles, least(doc_id, coalesce((select min(b) from reach where a = doc_id), doc_id)) component_id
    from documents left join n using (doc_id)"""


def centroids_sql() -> str:
    m = centroids
    parts = [
        f"""v as materialized (select vec_id, list_transform(embedding, lambda x: floor({m.SCALE} * x::double)::bigint) v from embeddings
      where len(embedding) = {m.DIMS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {m.DIMS})""",
        f"c0 as (select row_number() over (order by h) - 1 c, v cv from (select v, sha256('{m.SEED}:' || vec_id) h from v order by h limit {m.K}))",
    ]
    for r in range(m.ROUNDS + 1):
        far = "list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - cv[i]) * (v[i] - cv[i])))::bigint"
        parts.append(f"a{r} as materialized (select vec_id, v, arg_min(c, (d, c)) c, min(d) d from (select vec_id, v, c, {far} d from v, c{r}) group by vec_id, v)")
        if r < m.ROUNDS:
            parts.append(
                f"""s{r} as (select c, i, floor_div c_i from (select c, i, (sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*) floor_div
        from (select c, unnest(v)::hugeint x, unnest(range(1, len(v) + 1)) i from a{r}) group by c, i))"""
            )
            parts.append(f"c{r + 1} as materialized (select c, coalesce(n, cv) cv from c{r} left join (select c, list(c_i::bigint order by i) n from s{r} group by c) using (c))")
    return f"""with {", ".join(parts)}
    select vec_id, c::integer as cluster, d distance, (sum(d) over (partition by c))::bigint cluster_inertia, (sum(d) over ())::bigint inertia,
      sha256(array_to_string(cv, ',')) centroid_sha256 from a{m.ROUNDS} join c{m.ROUNDS} using (c)"""


def fim_sql() -> str:
    p, s, m = fim.PREFIX, fim.SUFFIX, fim.MIDDLE
    number = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::bigint"
    return f"""
    with d as (select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') w, sha256('1:' || doc_id) h from documents),
    k as (select doc_id, t, w, len(w) n, {", ".join(f"{number(i)} h{i + 1}" for i in range(4))} from d),
    c as (select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
      case when t = '' or contains(t, '{p}') or contains(t, '{s}') or contains(t, '{m}') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end form from k),
    x as (select *, array_to_string(w[1:a], '') pre, array_to_string(w[a + 1:b], '') mid, array_to_string(w[b + 1:], '') suf from c)
    select doc_id, n, form, case when form <> 'plain' then length(pre) end prefix_chars, case when form <> 'plain' then length(mid) end middle_chars,
      sha256(case form when 'psm' then '{p}' || pre || '{s}' || suf || '{m}' || mid when 'spm' then '{s}' || suf || '{p}' || pre || '{m}' || mid else t end) output_sha256,
      sha256(t) restored_sha256 from x"""


SQL = {
    "op2_mix_sources": mix_sql(),
    "op4_decontaminate": contamination_sql(),
    "op6_url_filter": url_sql(),
    "op10_ngram_join": groups_sql(),
    "op12_centroids": centroids_sql(),
    "op13_fill_in_middle": fim_sql(),
}
