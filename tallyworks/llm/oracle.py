"""SQL for the queries that SQL can express, over the given tables as views."""

from __future__ import annotations

from tallyworks.llm.quality_rules import BIT, POLICIES, RULES

_REACH = """
edges as (select a as x, b as y from links union select b, a from links),
reach(root, node) as (select distinct x, x from edges union select r.root, e.y from reach r join edges e on e.x = r.node),
parts as (select node, min(root) as component from reach group by node)
"""

#: Plain cosine of every pair of one label.
PIVOT_INDEX = f"""
with recursive vectors as (
  select cast(vec_id as bigint) as vec_id, label, cast(embedding as double[]) as v from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
  select p.vec_id as a, q.vec_id as b from vectors p join vectors q
  on p.label = q.label and p.vec_id < q.vec_id and len(p.v) = len(q.v) and list_cosine_similarity(p.v, q.v) >= 0.98
),
{_REACH},
counts as (select x, count(*) as n from edges group by x)
select e.vec_id, coalesce(c.n, 0) as n_links, coalesce(p.component, e.vec_id) as component_id,
  coalesce(p.component, e.vec_id) = e.vec_id as kept
from embeddings e left join counts c on c.x = e.vec_id left join parts p on p.node = e.vec_id
"""

#: Counts of shared shingles per pair. ASCII letters alone change case, and only the six given characters separate.
_WORDS = "list_filter(regexp_split_to_array({}, '[ \\t-\\r]+'), lambda x: x <> '')"
NGRAM_JOIN = f"""
with recursive words as (
  select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w
  from documents
),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [w]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i : i + 3])) end as s from words
),
grams as (select doc_id, len(s) as n, unnest(s) as g from sets),
links as (
  select x.doc_id as a, y.doc_id as b from grams x join grams y on x.g = y.g and x.doc_id < y.doc_id
  group by x.doc_id, y.doc_id, x.n, y.n having 100 * count(*) >= 85 * (x.n + y.n - count(*))
),
{_REACH}
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(p.component, s.doc_id) as component_id
from sets s left join parts p on p.node = s.doc_id
"""

_BITS = " | ".join(f"(case when {condition} then {BIT[name]} else 0 end)" for name, condition in RULES)
QUALITY_RULES = f"""
with words as (
  select doc_id, coalesce(text, '') as text, {_WORDS.format("coalesce(text, '')")} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) as l from documents
),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, w[i : i + 2]) as n
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words where len(w) > 2)
),
covered as (
  select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from windows where n > 1) group by doc_id
),
measures as (
  select d.doc_id, cast(len(w) as bigint) as n_words, cast(length(list_aggregate(w, 'string_agg', '')) as bigint) as c,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) as bigint) as n_lines, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    cast(coalesce(c.n, 0) as bigint) as n_repeat_words
  from words d left join covered c on c.doc_id = d.doc_id
),
ledger as (select *, cast({_BITS} as integer) as failed from (select * exclude (c), coalesce(c, 0) as word_chars from measures))
select *, failed & {POLICIES["base"]} <> 0 as base_failed, failed & {POLICIES["base"] | POLICIES["v1"]} = 0 as kept from ledger
"""

#: Stretches of lines with ten words; those that also start earlier are deleted.
LINE_WINNOW = """
with lines as (
  select doc_id, generate_subscripts(l, 1) - 1 as pos, unnest(l) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
),
units as (
  select doc_id, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line,
    len(list_filter(regexp_split_to_array(line, '[ \\t-\\r]+'), lambda x: x <> '')) as words,
    row_number() over (partition by doc_id order by pos) as k
  from lines where regexp_matches(line, '[^ \\t-\\r]')
),
sums as (select *, sum(words) over (partition by doc_id order by k) as upto from units),
stops as (
  select a.doc_id, a.k, a.pos, min(b.k) as stop_k, min(b.pos) as stop from sums a join sums b
  on a.doc_id = b.doc_id and b.k between a.k and a.k + 9 and b.upto - a.upto + a.words >= 10 group by 1, 2, 3
),
windows as (
  select s.doc_id, s.pos, s.stop, string_agg(u.line, chr(10) order by u.k) as content
  from stops s join units u on u.doc_id = s.doc_id and u.k between s.k and s.stop_k group by 1, 2, 3
),
later as (select *, row_number() over (partition by content order by doc_id, pos) as n from windows qualify n > 1),
gone as (select distinct doc_id, unnest(range(pos, stop + 1)) as pos from later),
runs as (
  select doc_id, count(*) as n_removed, count_if(pos - coalesce(before, -2) > 1) as n_runs
  from (select doc_id, pos, lag(pos) over (partition by doc_id order by pos) as before from gone) group by doc_id
),
kept as (
  select l.doc_id, count(*) as n_lines, string_agg(l.line, chr(10) order by l.pos) filter (where g.pos is null) as text
  from lines l left join gone g on g.doc_id = l.doc_id and g.pos = l.pos group by l.doc_id
)
select k.doc_id, k.n_lines, cast(coalesce(r.n_removed, 0) as bigint) as n_removed, cast(coalesce(r.n_runs, 0) as bigint) as n_runs,
  sha256(coalesce(k.text, '')) as kept_sha256
from kept k left join runs r on r.doc_id = k.doc_id
"""



def _means(rounds: int = 10, k: int = 8, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Assignments to the nearest centroid and their exact means, round by round."""

    def nearest(r: int) -> str:
        far = "list_sum(list_transform(range(1, {dim} + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))".format(dim=dim)
        return f"""a{r} as materialized (
  select row, vec_id, x, c, cast(far as bigint) as far from (
    select v.row, v.vec_id, v.x, c.c, {far} as far from vectors v cross join c{r} c
  ) qualify row_number() over (partition by row order by far, c) = 1
)"""

    def means(r: int) -> str:
        return f"""s{r} as (
  select c, i, sum(v) as s, count(*) as n from (select c, generate_subscripts(x, 1) as i, unnest(x) as v from a{r - 1}) group by c, i
),
c{r} as materialized (
  select o.c, coalesce(m.x, o.x) as x from c{r - 1} o left join (
    select c, list(cast((s - (((s % n) + n) % n)) // n as bigint) order by i) as x from s{r} group by c
  ) m on m.c = o.c
)"""

    steps = ",\n".join(x for r in range(rounds + 1) for x in ([means(r)] if r else []) + [nearest(r)])
    return f"""
with vectors as materialized (
  select row_number() over () as row, cast(vec_id as bigint) as vec_id,
    list_transform(embedding, lambda v: cast(floor(cast(v as double) * {scale}) as bigint)) as x
  from embeddings where len(embedding) = {dim} and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
),
c0 as materialized (
  select row_number() over (order by h) - 1 as c, x from (
    select sha256('{seed}:' || vec_id) as h, x from vectors order by h nulls last limit {k}
  )
),
{steps},
sums as (select c, cast(sum(far) as bigint) as far from a{rounds} group by c)
select a.vec_id, cast(a.c as integer) as cluster, a.far as distance, s.far as cluster_inertia,
  cast((select sum(far) from sums) as bigint) as inertia, sha256(array_to_string(m.x, ',')) as centroid_sha256
from a{rounds} a join sums s on s.c = a.c join c{rounds} m on m.c = a.c
"""


ORACLE: dict[str, str] = {
    "op1_pivot_index": PIVOT_INDEX,
    "op5_line_winnow": LINE_WINNOW,
    "op9_ngram_join": NGRAM_JOIN,
    "op10_quality_rules": QUALITY_RULES,
    "op12_va_file": _means(),
}
