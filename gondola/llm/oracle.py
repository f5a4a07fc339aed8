"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

from __future__ import annotations

SQL = {
    "op4_decontaminate": r"""
with lowered as (
    select doc_id, row_number() over () as row, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), item as (
    select item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where item_id is not null
), win as (
    select distinct item_id, least(len(w), 10) as size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
    from (select *, unnest(generate_series(1, greatest(len(w) - 9, 1))) as i from item where len(w) > 0)
), doc_win as (
    select row, size, i, array_to_string(w[i:i + size - 1], ' ') as win
    from (select row, w, size, unnest(generate_series(1, len(w) - size + 1)) as i
          from lowered cross join (select distinct size from win) where len(w) >= size)
), hit as (
    select distinct row, item_id, d.size, i from doc_win d join win on d.win = win.win and d.size = win.size
), words_hit as (
    select row, count(distinct p) as n_hit
    from (select row, unnest(generate_series(i, i + size - 1)) as p from hit) group by row
), items_hit as (
    select row, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct row, cast(item_id as varchar) as item from hit) group by row
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from lowered left join words_hit using (row) left join items_hit using (row)
""",
    "op6_search": r"""
with v as (
    select vec_id, min(x) as x from (
        select vec_id, list_transform(embedding, lambda e: cast(floor(64 * cast(e as double)) as bigint)) as x
        from embeddings
        where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0 and len(embedding) > 0
    ) group by vec_id
), scored as (
    select q.vec_id as query_id, c.vec_id,
        cast(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) as bigint) as score
    from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 20
""",
    "op11_vector_dedup": r"""
with recursive v as (
    select row_number() over () as i, vec_id, label, embedding,
        list_transform(embedding, lambda e: cast(e as double)) as x
    from embeddings
), good as (
    select i, vec_id, label, x, sqrt(list_sum(list_transform(x, lambda e: e * e))) as norm from v
    where label is not null and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
        and len(list_filter(x, lambda e: e <> 0)) > 0
), link as (
    select a.i as a, b.i as b from good a join good b on a.label = b.label and len(a.x) = len(b.x) and a.i <> b.i
    where list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) / (a.norm * b.norm) >= 0.93
), reach as (
    select i, i as j from v union select reach.i, link.b from reach join link on reach.j = link.a
), component as (
    select reach.i, min(v.vec_id) as component_id from reach join v on v.i = reach.j group by reach.i
), degree as (select a as i, count(*) as n_links from link group by a)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id is not distinct from component_id as kept
from v join component using (i) left join degree using (i)
""",
    "op13_filters": r"""
with counted as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
    from documents
), label as (
    select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
    from labels where doc_id is not null group by doc_id
), failed as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        case when len(w) < 200 then 'A' else '' end
        || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
        || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 'C' else '' end
        || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
        || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as f
    from counted left join label using (doc_id)
), mask as (
    select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from failed group by part, f
), letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as x), orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order
    from letter a join letter b on b.x <> a.x join letter c on c.x not in (a.x, b.x)
        join letter d on d.x not in (a.x, b.x, c.x) join letter e on e.x not in (a.x, b.x, c.x, d.x)
), gone as (
    select part, filter_order, f, n, good, toxic,
        list_min(list_transform(string_split(f, ''), lambda x: strpos(filter_order, x))) as step
    from mask join orders on true where f <> ''
), grid as (
    select part, filter_order, step, substr(filter_order, step, 1) as x, all_docs
    from (select part, sum(n) as all_docs from mask group by part) join orders on true
        join (select unnest([1, 2, 3, 4, 5]) as step) on true
), failing as (
    select part, x, sum(n) as failing, sum(case when f = x then n else 0 end) as unique_fails
    from mask join letter on strpos(f, x) > 0 group by part, x
), removed as (
    select part, filter_order, step, sum(n) as n, sum(good) as good, sum(toxic) as toxic
    from gone group by part, filter_order, step
), filled as (
    select g.*, coalesce(n, 0) as n, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        coalesce(failing, 0) as failing, coalesce(unique_fails, 0) as unique_fails
    from grid g left join removed using (part, filter_order, step) left join failing using (part, x)
)
select part, filter_order, cast(step as integer) as step,
    cast(all_docs - sum(n) over (partition by part, filter_order order by step) as bigint) as kept,
    cast(n as bigint) as removed, cast(failing - n as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
    cast(good as bigint) as good_lost, cast(toxic as bigint) as toxic_lost,
    cast(sum(n) over (partition by part, x) as bigint) as shapley
from filled
""",
}
