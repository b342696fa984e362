"""SQL for DuckDB that gives the rows of the queries."""

OP1 = r"""
with d as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix|' || coalesce(doc_id::varchar, '')) as r
  from documents
), s as (
  select source, sum(size)::bigint as source_size,
         row_number() over (order by source nulls last) as rnk
  from d group by source
), w as (
  select *, [5.0, 2.0, 1.0][((rnk - 1) % 3 + 1)::int]::double as weight, 3.0::double * source_size as lim
  from s
), l as (
  select *, ((sum(source_size) over ())::double
             - coalesce(sum(lim) over (order by lim / weight, rnk rows between unbounded preceding and 1 preceding), 0)) as rest,
         sum(weight) over (order by lim / weight, rnk rows between current row and unbounded following) as wsum
  from w
), o as (
  select rest, wsum from l where rest * weight / wsum <= lim order by lim / weight, rnk limit 1
), t as (
  select l.source, l.rnk, l.source_size,
         coalesce(least(o.rest * l.weight / o.wsum, l.lim), l.lim) as target
  from l left join o on true
), c as (
  select d.*, t.source_size, t.target, t.rnk, floor(t.target)::bigint as words,
         coalesce(sum(d.size) over (partition by d.source order by d.r, d.size rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from d join t on d.source is not distinct from t.source
), e as (
  select *, case when source_size > 0 then words // source_size else 0 end as rounds from c
), k as (
  select *, greatest(least(words - rounds * source_size - start, size), 0) as part from e
), p as (
  select *, rounds * size + part as taken,
         [0.5 * 4.0, 0.5 * 2.0, 0.5 * 2.0][((rnk - 1) % 3 + 1)::int]::double as g1,
         [0.5 * 6.0, 0.5 * 2.0, 0.0][((rnk - 1) % 3 + 1)::int]::double as g2
  from k
), x as (
  select *, (start::double / target) * (g1 + g2) as wanted from p
)
select doc_id, size, source_size, target, taken::bigint as taken,
       case when taken > 0 then
         0.5 * greatest(least(wanted / g1, 1.0), 0.0)
         + 0.5 * case when g2 > 0 then greatest(least((wanted - g1) / g2, 1.0), 0.0)
                      else (wanted >= g1)::int::double end
       end as position
from x
"""

OP2 = """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), b as (
  select doc_id, unnest(range((length(h) // 2)::bigint)) as i, unnest(regexp_extract_all(h, '..')) as x from d
), w as (
  select b.doc_id, b.i, substring(d.h, 2 * b.i + 1, 100) as s
  from b join d using (doc_id) where 2 * b.i + 100 <= length(d.h)
), k as (
  select s, min(doc_id) as least from w group by s having min(doc_id) < max(doc_id)
), f as (
  select w.doc_id, w.i, true as again from w join k using (s) where k.least < w.doc_id
), m as (
  select b.doc_id, b.i, b.x,
         coalesce(max(f.again::int) over (partition by b.doc_id order by b.i rows between 49 preceding and current row), 0) as gone
  from b left join f using (doc_id, i)
), r as (
  select *, gone = 1 and coalesce(lag(gone) over (partition by doc_id order by i), 0) = 0 as head from m
), g as (
  select doc_id, sum(gone)::bigint as n_removed, sum(head::int)::bigint as n_spans,
         string_agg(x, '' order by i) filter (gone = 0) as kept
  from r group by doc_id
)
select d.doc_id, length(d.h) // 2 as n_bytes, coalesce(g.n_removed, 0) as n_removed,
       coalesce(g.n_spans, 0) as n_spans, sha256(unhex(coalesce(g.kept, ''))) as kept_sha256
from d left join g using (doc_id)
"""

OP9 = r"""
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), b as (
  select doc_id, words, unnest(range(len(words))) as i from d
), w as (
  select doc_id, i, array_to_string(words[i + 1 : i + 13], ' ') as s from b where i + 13 <= len(words)
), k as (
  select s, min(doc_id) as least from w group by s having min(doc_id) < max(doc_id)
), f as (
  select w.doc_id, w.i, true as again from w join k using (s) where k.least < w.doc_id
), m as (
  select b.doc_id, b.i, b.words[b.i + 1] as x,
         coalesce(max(f.again::int) over (partition by b.doc_id order by b.i rows between 12 preceding and current row), 0) as gone
  from b left join f using (doc_id, i)
), g as (
  select doc_id, sum(gone)::bigint as n_removed, string_agg(x, ' ' order by i) filter (gone = 0) as kept
  from m group by doc_id
)
select d.doc_id, len(d.words) as n_words, coalesce(g.n_removed, 0) as n_removed,
       sha256(coalesce(g.kept, '')) as kept_sha256
from d left join g using (doc_id)
"""

OP8 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024.0::double * x::double)::bigint) as e, len(embedding) as n
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2]))::bigint as score
  from v q join v c on q.n = c.n and q.vec_id <> c.vec_id and q.vec_id % 100 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from p
)
select query_id, rank, vec_id, score from r where rank <= 10
"""

#: Components of the links `e` (u, v) between the rows `n` (node).
REACH = """
r as (
  select node, node as least from n
  union
  select e.v, r.least from r join (select u, v from e union select v, u from e) e on e.u = r.node
), c as (
  select node, min(least) as component from r group by node
)
"""

OP6 = f"""
with recursive a as (
  select vec_id, label,
         case when label is not null and embedding is not null and len(embedding) > 0
               and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
               and len(list_filter(embedding, lambda x: x <> 0)) > 0
              then embedding::double[] end as x
  from embeddings
), n as (
  select vec_id as node from a
), p as (
  select a.vec_id as u, b.vec_id as v
  from a join a b on a.label = b.label and a.vec_id < b.vec_id and len(a.x) = len(b.x)
  where list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.93
), e as (
  select u, v from p
), {REACH}
select vec_id, (select count(*) from p where u = vec_id or v = vec_id) as n_links,
       component as component_id, vec_id = component as kept
from a join c on c.node = a.vec_id
"""

OP10 = f"""
with recursive d as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') as w
  from documents
), n as (
  select doc_id as node from d
), s as (
  select distinct doc_id, array_to_string(w[i + 1 : i + 5], ' ') as t
  from (select doc_id, w, unnest(range(greatest(len(w) - 4, least(len(w), 1)))) as i from d)
), z as (
  select doc_id, count(*) as size from s group by doc_id
), p as (
  select a.doc_id as u, b.doc_id as v, count(*) as shared
  from s a join s b on a.t = b.t and a.doc_id < b.doc_id group by all
), e as (
  select u, v from p join z a on a.doc_id = u join z b on b.doc_id = v
  where 100 * shared >= 75 * (a.size + b.size - shared)
), {REACH}
select d.doc_id, coalesce(z.size, 0) as n_shingles, c.component as component_id
from d left join z using (doc_id) join c on c.node = d.doc_id
"""

#: The checksum's polynomial, and its table by rule.
CRC_TABLE = """
z as (
  select list_transform(range(256), lambda i:
           list_reduce(list_concat([i], range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
)
"""

OP12 = f"""
with recursive {CRC_TABLE}, r as (
  select coalesce(doc_id::varchar, '') as doc_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) as run
  from documents
), o as (
  select doc_id, run, count(*) as k, hex(encode(doc_id || ':' || run)) as bytes from r where length(run) >= 5 group by doc_id, run
), h as (
  select run, k, xor(list_reduce(
           list_concat([4294967295], list_transform(range(length(bytes) // 2), lambda i: ('0x' || substring(bytes, (2 * i + 1)::int, 2))::bigint)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as h
  from o, z
), m as (
  select case when h % 97 = 0 then substring(run, 1, (h % length(run))::int) || substring(run, (h % length(run))::int + 2) else run end as word, k
  from h
), w as (
  select word, sum(k)::bigint as n from m where length(word) >= 5 group by word having sum(k) >= 3
), g as (
  select word, n, unnest(range(length(word))) as i from w
), d as (
  select word, n, i, substring(word, 1, i::int) as a, substring(word, i::int + 2) as b from g
), p as (
  select x.word, y.word as other, y.n from d x join d y using (i, a, b) where x.word <> y.word
  union select d.word, w.word, w.n from d join w on w.word = d.a || d.b
  union select w.word, d.word, d.n from d join w on w.word = d.a || d.b
), q as (
  select word, count(*) as n_near, max(n) as most, arg_min(other, (-n, encode(other))) as best from p group by word
), f as (
  select w.word, w.n, coalesce(q.n_near, 0) as n_near,
         case when q.most >= 2 * w.n then q.best end as form, case when q.most >= 2 * w.n then q.most end as form_n
  from w left join q using (word)
), s as (
  select word, word as at, 0 as steps from f
  union all
  select s.word, f.form, s.steps + 1 from s join f on f.word = s.at where f.form is not null
)
select word, form, (select arg_max(s.at, s.steps) from s where s.word = f.word) as root, n, n_near, form_n from f
"""

ORACLE_SQL = {
    "op1_mixing": OP1,
    "op2_suffix_dedup": OP2,
    "op6_near_vectors": OP6,
    "op8_top_k": OP8,
    "op9_substring_dedup": OP9,
    "op10_ngram_jaccard": OP10,
    "op12_spelling_variants": OP12,
}
