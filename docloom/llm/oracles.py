"""DuckDB SQL of the registered queries that SQL can express over whole tables."""

from __future__ import annotations

_FINITE = "embedding is not null and len([e for e in embedding if e is null or not isfinite(e)]) = 0"


def _centroids(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, salt: str = "3:") -> str:
    steps = [
        f"""x as materialized (
  select row_number() over () as row_id, vec_id, [floor({scale} * e::double) for e in embedding] as v
  from embeddings where len(embedding) = {size} and {_FINITE})""",
        f"""c0 as materialized (
  select row_number() over (order by sha256('{salt}' || vec_id), v) - 1 as cluster, v
  from x where vec_id is not null order by cluster limit {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (
  select row_id, min({{'d': list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, c.v) + list_inner_product(c.v, c.v), 'cluster': cluster}}) as best
  from x cross join c{i} c group by row_id)""")
        if i < rounds:
            steps.append(f"""c{i + 1} as materialized (
  select c.cluster, coalesce(moved.v, c.v) as v
  from c{i} c left join (
    select cluster, list(((total - ((total % n) + n) % n) // n)::double order by place) as v
    from (
      select best.cluster as cluster, place, sum(value::bigint) as total, count(*) as n
      from (select a.best, unnest(x.v) as value, unnest(range({size})) as place from a{i} a join x using (row_id))
      group by 1, 2)
    group by cluster) moved using (cluster))""")
    return "with " + ",\n".join(steps) + f"""
select x.vec_id, best.cluster::integer as cluster, best.d::bigint as distance,
  sum(best.d::bigint) over (partition by best.cluster)::bigint as cluster_inertia,
  sum(best.d::bigint) over ()::bigint as inertia,
  sha256(array_to_string([e::bigint for e in c.v], ',')) as centroid_sha256
from x join a{rounds} using (row_id) join c{rounds} c on c.cluster = best.cluster"""


_TOP_K = f"""with x as (
  select vec_id, [floor(256 * e::double) for e in embedding] as v
  from embeddings where vec_id is not null and {_FINITE}),
q as (select vec_id, min(v) as v from x where vec_id % 50 = 0 group by vec_id),
ranked as (
  select q.vec_id as query_id, x.vec_id, list_inner_product(q.v, x.v)::bigint as score
  from q join x on len(q.v) = len(x.v) and q.vec_id <> x.vec_id)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
from ranked qualify rank <= 5"""

_MEDIANS = """with once as (
  select click_id, min({'ts': ts, 'kind': kind, 'value': value}) as it from clicks where ts is not null group by click_id),
events as (
  select click_id, it.kind as kind, it.ts as ts, floor(100 * it.value + 0.5)::bigint as cents from once),
windows as (
  select *, count(cents) over w as n, median(cents) over w as middle, mad(cents) over w as deviation
  from events window w as (partition by kind order by ts range between interval 60 minutes preceding and current row)),
doubled as (
  select click_id, kind, cents, n, case when n >= 2 then (2 * middle)::bigint end as median2, case when n >= 2 then (4 * deviation)::bigint end as mad4
  from windows)
select click_id, kind, n, median2, mad4, 2 * abs(2 * cents - median2) > 3 * mad4 as far from doubled"""

_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _windows(table: str, key: str, most: str, length: str) -> str:
    """Windows of a table's word lists ``a``: key, start and words joined by spaces, which no word holds."""
    return f"select {key}, start, array_to_string(list_slice(a, start, start + {length} - 1), ' ') as win from (select {key}, a, unnest(range(1, {most} + 1)) as start from {table})"


_GROUPS = rf"""with recursive d as materialized (select doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_SPACED}') as a from documents),
 shingles as (select distinct doc_id, win from ({_windows("(select doc_id, a from d where len(a) >= 5)", "doc_id", "len(a) - 4", "5")})
  union all select doc_id, array_to_string(a, ' ') from d where len(a) between 1 and 4),
 numbered as materialized (select doc_id, dense_rank() over (order by win) as s from shingles),
 sizes as materialized (select doc_id, count(*) as n from numbered group by 1),
 common as (select x.doc_id as a, y.doc_id as b, count(*) as n from numbered x join numbered y on x.s = y.s and x.doc_id < y.doc_id group by 1, 2),
 links as materialized (select a, b from common c join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c.n >= 75 * (x.n + y.n - c.n)),
 edges as materialized (select a, b from links union all select b, a from links),
 reach as (select doc_id, doc_id as root from d union select e.b, r.root from reach r join edges e on e.a = r.doc_id)
select d.doc_id, coalesce(any_value(sizes.n), 0) as n_shingles, min(root) as component_id from d left join sizes using (doc_id) join reach using (doc_id) group by d.doc_id"""

_REPEATS = rf"""with d as materialized (select doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') as a from documents),
 windows as ({_windows("d", "doc_id", "len(a) - 19", "20")}),
 repeated as (select doc_id, start from (select doc_id, start, row_number() over (partition by win order by doc_id, start) as place from windows) where place > 1),
 removed as materialized (select distinct doc_id, unnest(range(start, start + 20)) as place from repeated),
 words as (select doc_id, unnest(a) as word, generate_subscripts(a, 1) as place from d),
 kept as (select doc_id, string_agg(word, ' ' order by place) as kept_text from words anti join removed using (doc_id, place) group by doc_id),
 gone as (select doc_id, count(*) as n from removed group by doc_id)
select d.doc_id, len(a)::bigint as n_words, coalesce(gone.n, 0)::bigint as n_removed, sha256(coalesce(kept_text, '')) as kept_sha256 from d left join gone using (doc_id) left join kept using (doc_id)"""

_HITS = rf"""with d as materialized (select doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_ALNUM}') as a from documents),
 items as materialized (select item_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_ALNUM}') as a from benchmark),
 item_windows as materialized (select distinct item_id, win, 10 as size from ({_windows("(select item_id, a from items where len(a) >= 10)", "item_id", "len(a) - 9", "10")})
  union all select item_id, array_to_string(a, ' '), len(a) from items where len(a) between 1 and 9),
 lengths as (select distinct size from item_windows),
 windows as (select doc_id, size, start, array_to_string(list_slice(a, start, start + size - 1), ' ') as win from (select doc_id, a, size, unnest(range(1, len(a) - size + 2)) as start from d cross join lengths)),
 hits as materialized (select doc_id, w.size, start, item_id from windows w join item_windows i on i.size = w.size and i.win = w.win),
 words as (select doc_id, count(*) as n from (select distinct doc_id, unnest(range(start, start + size)) as place from hits) group by doc_id),
 found as (select doc_id, count(*) as n, string_agg(item_id, ',' order by item_id) as ids from (select distinct doc_id, item_id::varchar as item_id from hits) group by doc_id)
select d.doc_id, len(a)::bigint as n_words, coalesce(words.n, 0)::bigint as n_hit, coalesce(found.n, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from d left join words using (doc_id) left join found using (doc_id)"""

ORACLES = {
    "op3_jaccard_groups": _GROUPS, "op4_substring_dedup": _REPEATS, "op8_benchmark_hits": _HITS,
    "op11_exact_centroids": _centroids(), "op12_exact_top_k": _TOP_K, "op13_rolling_medians": _MEDIANS,
}
