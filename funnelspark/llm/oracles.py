"""DuckDB twins of the queries that SQL can express.

The others have none: trained models (op1, op5, op6), XXH64 shingles (op2),
tokenizer merges (op3), hash-ordered shards (op7) and HTML (op8).  Their tests
hold them against brute force, the tokenizer library or held-out labels.
"""

from .decontaminate import UNITS

_UNITS = ", ".join(f"'{u}'" for u in UNITS)

OP4 = rf"""
with t as (
    select 0 as side, doc_id as id, text, md5(coalesce(text, '')) as key from documents where doc_id is not null
    union all select 1, item_id, text, md5(coalesce(text, '')) from benchmark where item_id is not null),
w as (
    select distinct side, id, key, string_split(trim(lower(regexp_replace(regexp_replace(regexp_replace(
        replace(coalesce(text, ''), chr(2), ' '),
        '([^.!?\t\n\v\f\r ] )(\p{{Lu}}\p{{Ll}})', '\1' || chr(2) || '\2', 'g'),
        '([0-9])[.,]([0-9])', '\1_\2', 'g'),
        '[^\p{{L}}\p{{N}}_' || chr(2) || ']+', ' ', 'g'))), ' ') as w from t),
k as (
    select side, id, key, w, list_transform(range(1, len(w) + 1), lambda i: case
        when w[i] >= '0' and w[i] < ':' then case
            when translate(w[i], '0123456789_', '') = '' then chr(1) || '1'
            when translate(w[i], '0123456789_', '') in ({_UNITS}) then chr(1) || '3' else w[i] end
        when starts_with(w[i], chr(2)) then chr(1) || '2'
        when w[i] in ({_UNITS}) and i > 1 and w[i - 1] >= '0' and w[i - 1] < ':' then chr(1) || '4'
        else w[i] end) as k from w where len(w) >= 5),
v as (
    select side, id, key, place, w[place + 1:place + 5] as w, k[place + 1:place + 5] as k, places
    from (select side, id, key, w, k, len(w) - 4 as places, unnest(range(0, len(w) - 4)) as place from k)),
m as (
    select d.id as doc_id, d.key, b.id as item_id, b.key as item_key, b.places, b.place as spot, d.place - b.place as shift,
           b.k, b.w as theirs, d.w as ours, b.w = d.w as literal
    from v d join v b on d.k = b.k where d.side = 0 and b.side = 1),
f as (
    select doc_id, key, item_id, item_key, shift from m group by all
    having bool_or(literal or len(list_filter(k, lambda x: x[1] <> chr(1))) > 0)),
s as (
    select distinct doc_id, key, item_id, item_key, shift, spot + i as pos, k[i] as kind, theirs[i] as theirs, ours[i] as ours
    from (select *, unnest(range(1, 6)) as i from m semi join f using (doc_id, key, item_id, item_key, shift)) where k[i][1] = chr(1)),
votes as (select doc_id, key, item_id, item_key, shift, kind, theirs, ours, count(*) as n, min(pos) as first from s group by all),
lost as (
    select * from (select *, row_number() over (partition by doc_id, key, item_id, item_key, shift, kind, theirs order by n desc, first) as r
                   from votes) where r > 1),
gone as (
    select distinct doc_id, key, item_id, item_key, shift, spot
    from (select *, unnest(range(1, 6)) as i from m where not literal) p
    semi join lost l on p.doc_id = l.doc_id and p.key = l.key and p.item_id = l.item_id and p.item_key = l.item_key
        and p.shift = l.shift and p.k[p.i] = l.kind and p.theirs[p.i] = l.theirs and p.ours[p.i] = l.ours),
whole as (
    select doc_id, item_id, places, key, item_key, count(distinct spot)::int as matched, bool_or(not literal) as reworded
    from m semi join f using (doc_id, key, item_id, item_key, shift) anti join gone using (doc_id, key, item_id, item_key, shift, spot)
    group by all having count(distinct spot) >= 0.8 * places)
select doc_id, item_id, matched, places::int as places, reworded
from (select *, row_number() over (partition by doc_id, item_id, places order by matched desc, reworded) as r from whole) where r = 1"""

OP9 = """
with d as (select doc_id, encode(coalesce(text, '')) as b from documents),
p as (select doc_id, s, b[s + 1:s + 100] as k
      from (select doc_id, b, unnest(range(0, octet_length(b) - 99)) as s from d where octet_length(b) >= 100)),
f as (select doc_id, s, min(doc_id::hugeint * 4294967296 + s) over (partition by k) as first from p),
r as (select doc_id, s, s - lag(s) over (partition by doc_id order by s) as gap
      from f where doc_id::hugeint * 4294967296 + s > first),
g as (select doc_id, s, sum((gap is null or gap > 100)::int) over (partition by doc_id order by s) as run from r),
runs as (select doc_id, min(s) as lo, max(s) + 100 as hi from g group by doc_id, run),
n as (select doc_id, sum(hi - lo)::bigint as n_removed, count(*) as n_spans from runs group by doc_id),
cuts as (select doc_id, lo, hi from runs union all select doc_id, octet_length(b), octet_length(b) from d),
kept as (
    select doc_id, string_agg(hex(b[lo_kept + 1:lo]), '' order by lo, hi) as h
    from (select c.doc_id, d.b, c.lo, c.hi, coalesce(lag(c.hi) over (partition by c.doc_id order by c.lo, c.hi), 0) as lo_kept
          from cuts c join d using (doc_id)) where lo > lo_kept group by doc_id)
select doc_id, octet_length(b)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(h, ''))) as kept_sha256
from d left join n using (doc_id) left join kept using (doc_id)"""

#: A stated query set against all rows is a join there.
OP10 = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
    select q.vec_id as query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
    from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10"""

ORACLE_SQL: dict[str, str] = {
    "op4_benchmark_decontamination": OP4,
    "op9_suffix_array_dedup": OP9,
    "op10_top_k_search": OP10,
}
