"""DuckDB SQL of the queries that SQL can express, by plain definitions."""

from __future__ import annotations

from veriledger.llm import secrets

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def decontamination() -> str:
    words = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
with d as (select doc_id, {words} as w from documents),
b as (select item_id, {words} as w from benchmark),
bw as (select item_id, size, array_to_string(w[i:i + size - 1], ' ') as g
  from (select item_id, w, least(13, len(w)) as size, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i
    from b where len(w) > 0)),
dw as (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as g
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
    from d, (select distinct size from bw) where len(w) >= size)),
h as (select dw.doc_id, dw.i, size, item_id from dw join bw using (size, g)),
n as (select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as p from h) group by doc_id),
s as (select doc_id, count(distinct item_id) as n_items,
  array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as items from h group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join n using (doc_id) left join s using (doc_id)
"""


def jaccard(percent: int = 85, more: str = "") -> str:
    return rf"""
with recursive w as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
g as (select doc_id, case when len(w) >= 4 then list_distinct(list_transform(range(1, len(w) - 2),
    lambda i: array_to_string(w[i:i + 3], ' '))) when len(w) > 0 then [array_to_string(w, ' ') || ' '] else [] end as g from w),
e as (select doc_id, len(g) as n, unnest(g) as s from g),
l as (select a.doc_id as a, b.doc_id as b from e a join e b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
r as (select doc_id as a, doc_id as b from g union select r.a, l.b from r join l on r.b = l.a)
select doc_id, len(g) as n_shingles, min(r.b) as component_id{more} from g join r on r.a = doc_id group by doc_id, len(g)
"""


def hard_negatives() -> str:
    return """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c as (select vec_id, label, unnest(v) as x, unnest(range(len(v))) as i from e),
s as (select a.vec_id as anchor, b.vec_id as id, a.label = b.label as same, cast(sum(a.x * b.x) as bigint) as score
  from c a join c b using (i) where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id group by a.vec_id, b.vec_id, a.label, b.label),
p as (select anchor, id, score from s where same qualify row_number() over (partition by anchor order by score desc, id) <= 5),
n as (select p.anchor, p.id as positive_id, p.score as positive_score, s.id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor, p.id order by s.score desc, s.id) as rank
  from p join s on s.anchor = p.anchor and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
select anchor as anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score
from n where rank <= 5
"""


def centroids(count: int = 16, rounds: int = 3) -> str:
    """Each round's assignment and means are parts of one statement."""
    parts = [f"""
with kept as (select row_number() over () as r, vec_id,
    list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
x as (select r, unnest(v) as x, unnest(range(64)) as i from kept),
f as (select row_number() over (order by sha256('1:' || vec_id), v) - 1 as c, v from kept where vec_id is not null
  qualify c < {count}),
c0 as (select c, unnest(v) as x, unnest(range(64)) as i from f)"""]
    for k in range(rounds + 1):
        parts.append(f"""
a{k} as (select r, c, d from (select x.r, c.c, cast(sum((x.x - c.x) * (x.x - c.x)) as bigint) as d
    from x join c{k} c using (i) group by x.r, c.c) qualify row_number() over (partition by r order by d, c) = 1)""")
        if k < rounds:
            parts.append(f"""
m{k} as (select c, i, sum(x) as t, count(*) as n from x join a{k} using (r) group by c, i),
c{k + 1} as (select c, cast((t - ((t % n) + n) % n) // n as bigint) as x, i from m{k}
  union all select c, x, i from c{k} where c not in (select c from m{k}))""")
    return ",".join(parts) + f""",
h as (select c, sha256(string_agg(cast(x as varchar), ',' order by i)) as centroid_sha256 from c{rounds} group by c),
t as (select c, cast(sum(d) as bigint) as cluster_inertia from a{rounds} group by c)
select vec_id, cast(c as int) as cluster, d as distance, cluster_inertia,
  (select cast(sum(d) as bigint) from a{rounds}) as inertia, centroid_sha256
from kept join a{rounds} using (r) join h using (c) join t using (c)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches(name: str, pattern: str, group: int, least: int) -> str:
    """Start, end and value of a pattern's matches: parts and matches take turns."""
    p = _quoted(pattern)
    return f"""(select doc_id, {_quoted(name)} as kind, start, start + length(m[k]) as stop, v[k] as value
  from (select doc_id, m, v, k, list_sum(list_transform(p[1:k], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) as start
    from (select doc_id, m, v, p, unnest(range(1, len(m) + 1)) as k
      from (select doc_id, string_split_regex(t, {p}) as p, regexp_extract_all(t, {p}) as m,
        regexp_extract_all(t, {p}, {group}) as v from t)))
  where length(v[k]) >= {least})"""


def secret_scan() -> str:
    known = " union all ".join(
        f"select doc_id, {rank} as rank, kind, start, stop from {_matches(kind, pattern, group, least)}"
        for rank, (kind, pattern, group, least) in enumerate(secrets.FORMS))
    bound = "case " + " ".join(
        "when " + " and ".join([f"regexp_matches(value, {_quoted(p)})" for p in holds]
                               + [f"not regexp_matches(value, {_quoted(p)})" for p in lacks])
        + f" then {secrets.most_score(bits)}" for _, holds, lacks, bits in secrets.CLASSES
    ) + " end"
    allowed = " or ".join([f"regexp_matches(value, {_quoted(p)})" for p in secrets.ALLOWED]
                          + [f"not regexp_matches(value, {_quoted(secrets.UNLIKE_WORDS)})"])
    size = secrets.WINDOW
    return f"""
with t as (select doc_id, coalesce(text, '') as t from documents),
known as ({known}),
run as (select *, exists (select 1 from known k where k.doc_id = c.doc_id and k.start < c.stop and c.start < k.stop) as cut
  from {_matches("candidate", secrets.CANDIDATE, 0, size)} c),
open as (select doc_id, start, p, value, p - row_number() over (partition by doc_id, start order by p) as island
  from (select doc_id, start, value, unnest(range(cast(start as bigint), cast(stop as bigint))) as p from run where cut) r
  where not exists (select 1 from known k where k.doc_id = r.doc_id and k.start <= r.p and r.p < k.stop)),
piece as (select doc_id, start, value from run where not cut
  union all select doc_id, cast(min(p) as bigint), any_value(value)[min(p) - start + 1:max(p) - start + 1]
  from open group by doc_id, start, island having count(*) >= {size}),
c as (select doc_id, start, value, {bound} as most from piece where not ({allowed})),
x as (select doc_id, start, most, i, value[i + 1:i + {size}] as w
  from (select *, unnest(range(0, length(value) - {size} + 1)) as i from c where most is not null)),
scored as (select doc_id, start, i, most, list_sum(list_transform(list_distinct(string_split(w, '')),
    lambda c: {secrets.SCORES}[{size} - length(replace(w, c, '')) + 1])) as score from x),
more as (select doc_id, {len(secrets.FORMS)} as rank, 'entropy' as kind, start + min(i) as start, start + max(i) + {size} as stop
  from scored where score <= most group by doc_id, start),
listed as (select *, kind || ':' || start || ':' || stop as entry from (select * from known union all select * from more))
select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
  count(*) filter (kind = 'hex') as n_hex,
  sha256(coalesce(string_agg(entry, ',' order by start, rank) filter (rank < {len(secrets.FORMS)}), '')) as base_sha256,
  coalesce(string_agg(entry, ',' order by start, rank, stop), '') as spans
from t left join listed using (doc_id) group by doc_id
"""
