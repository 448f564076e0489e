"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

from respan.llm.secrets import BASE_RULES, MORE_RULES

WHITE = r"[^\x20\x09-\x0D]+"
ITEM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAMINATION = rf"""with d as (select doc_id, regexp_extract_all({LOWER}, '{ITEM}') as w from documents),
it as (select id, w, least(10, len(w)) as s from (select cast(item_id as varchar) as id, regexp_extract_all({LOWER}, '{ITEM}') as w from benchmark) b where len(w) > 0),
iw as (select distinct id, s, array_to_string(w[i:i + s - 1], ' ') as k from (select *, unnest(range(1, len(w) - s + 2)) as i from it) x),
dw as (select doc_id, s, i, array_to_string(w[i:i + s - 1], ' ') as k from (select doc_id, w, s, unnest(range(1, len(w) - s + 2)) as i from d, (select distinct s from iw) z where len(w) >= s) x),
hit as (select doc_id, i, s, id from dw join iw using (s, k)),
covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + s)) as p from hit) x group by doc_id),
found as (select doc_id, count(*) as n, string_agg(id, ',' order by id) as ids from (select distinct doc_id, id from hit) x group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(c.n, 0)::bigint as n_hit, coalesce(f.n, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(c.n, 0) > 0 as contaminated
from d left join covered c using (doc_id) left join found f using (doc_id)"""


def _secrets() -> str:
    rules = [*BASE_RULES, *MORE_RULES]
    text = lambda p: "'" + p.replace("'", "''") + "'"
    parts = []
    for rank, r in enumerate(rules):
        p = text(r.pattern)
        parts.append(
            f"""select doc_id, {rank} as rank, '{r.kind}' as kind, start, start + length(m[i]) as stop from (
 select *, coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as start from (
  select *, unnest(range(1, len(m) + 1)) as i from (select doc_id, regexp_extract_all(t, {p}) as m, regexp_extract_all(t, {p}, {r.group}) as v, string_split_regex(t, {p}) as g from t) a) b) c where length(v[i]) >= {r.least}"""
        )
    tell = "coalesce(string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by start, rank)"
    counts = ", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in BASE_RULES)
    return f"""with t as (select doc_id, coalesce(text, '') as t from documents), f as ({" union all ".join(parts)})
select t.doc_id, {counts}, sha256({tell} filter (rank < {len(BASE_RULES)}), '')) as base_sha256, {tell}, '') as spans from t left join f using (doc_id) group by t.doc_id"""


SECRETS = _secrets()


REPEATS = f"""with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WHITE}') as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as k from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d) x),
gone as (select doc_id, list(distinct p) as ps from (select doc_id, unnest(range(i, i + 13)) as p from win join (select k, min(doc_id) as f from win group by k) z using (k) where f < doc_id) x group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(len(ps), 0)::bigint as n_removed,
 sha256(coalesce(array_to_string(list_filter(w, lambda x, i: not list_contains(coalesce(ps, []), i)), ' '), '')) as kept_sha256 from d left join gone using (doc_id)"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANKED = rf"""with t as (select row_number() over () as r, doc_id, regexp_extract_all({LOWER}, '{TERM}') as w from documents),
d as (select r, doc_id, len(w)::bigint as n from t where len(w) > 0), c as (select count(*)::bigint as nn, sum(n)::bigint as ll from d),
p as (select r, term, count(*)::bigint as tf from (select r, unnest(w) as term from t) x group by r, term),
q as (select distinct item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) as term from benchmark),
f as (select term, cast(floor(1000 * ln((2 * nn + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w from p, c where term in (select term from q) group by term, nn),
s as (select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::bigint as score from q join f using (term) join p using (term) join d using (r), c group by item_id, r, doc_id),
k as (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank from s where score > 0)
select item_id, rank::int as rank, doc_id, score from k where rank <= 10"""

NEAR_COPIES = f"""with recursive d as (select doc_id, regexp_extract_all({LOWER}, '{WHITE}') as w from documents),
s as (select distinct doc_id, k from (
 select doc_id, array_to_string(w[i:i + 4], ' ') as k from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d) x union all select doc_id, array_to_string(w, ' ') from d where len(w) between 1 and 4) y),
n as (select doc_id, count(*) as n, min(doc_id) over (partition by md5(string_agg(k, chr(10) order by k))) as class_id from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.k = b.k and a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
r as (select doc_id, doc_id as o from d union select r.doc_id, e.b from r join e on r.o = e.a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(class_id, d.doc_id) as class_id, min(o) as component_id from d join r using (doc_id) left join n using (doc_id) group by all"""
