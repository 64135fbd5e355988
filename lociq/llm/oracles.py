"""DuckDB equivalents of the queries that SQL can express: op5 and op9 compare all pairs, op8 groups payloads, op12 joins words
by what is left without a letter, op13 groups lines."""

# classes of linked ids: each id meets the smallest one that it can reach
REACH = """select id, min(other) as component from (with recursive reach(id, other) as (select id, id from {nodes} union select r.id, l.b from reach r join {links} l on l.a = r.other) select * from reach) group by 1"""

OP5 = f"""with v as (select row_number() over () as r, vec_id, embedding, vec_id is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0 as fine from embeddings),
f as (select r, vec_id, embedding::double[] as e from v where fine), u as (select r, vec_id, len(e) as dim, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) as e from f),
links as (select a.r as ra, a.vec_id as a, b.vec_id as b from u a join u b on a.r <> b.r and a.dim = b.dim and list_inner_product(a.e, b.e) >= 0.9), nodes as (select distinct vec_id as id from v where vec_id is not null),
n as (select ra, count(*) as n from links group by 1), c as ({REACH.format(nodes="nodes", links="links")})
select v.vec_id, coalesce(n.n, 0)::bigint as n_links, c.component as component_id, v.vec_id is not distinct from c.component as kept from v left join n on n.ra = v.r left join c on c.id = v.vec_id"""

# base 32 of a hexadecimal SHA-1: each letter stands for the five bits from bit 5 k on, which two neighbouring hexadecimal digits hold
BASE32 = "list_reduce(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((16 * (strpos('0123456789abcdef', substr(h, 1 + (5 * k) // 4, 1)) - 1) + strpos('0123456789abcdef', substr(h, 2 + (5 * k) // 4, 1)) - 1) >> (3 - (5 * k) % 4)) & 31)::int, 1)), lambda x, y: x || y)"

OP8 = f"""with p as (select page_id, encode(coalesce(html, '')) as payload from pages), d as (select page_id, octet_length(payload) as n, sha1(payload) as h from p), b as (select h, n, max(page_id) as best from d group by 1, 2)
select d.page_id, d.n::bigint as payload_bytes, {BASE32} as payload_digest, case when b.best is null or d.page_id = b.best then 'response' else 'revisit' end as record_type, case when d.page_id = b.best then null else b.best end as refers_to from d join b using (h, n)"""

OP9 = f"""with w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [md5(array_to_string(w, ' '))] else list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' '))) end) as shingle from w),
n as (select doc_id, count(*) as n from s group by 1), pairs as (select x.doc_id as a, y.doc_id as b, count(*) as shared from s x join s y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by 1, 2),
links as (select a, b from pairs join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * shared >= 75 * (na.n + nb.n - shared)), nodes as (select distinct doc_id as id from documents), c as ({REACH.format(nodes="nodes", links="links")})
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component as component_id, d.doc_id = c.component as kept from documents d left join n on n.doc_id = d.doc_id left join c on c.id = d.doc_id"""

# CRC-32 of the UTF-8 bytes of x, by a table of its 256 steps
CRC = "xor(list_reduce([4294967295::bigint] || list_transform(range(0, octet_length(encode(x))), lambda k: ('0x' || substr(hex(encode(x)), (1 + 2 * k)::int, 2))::bigint), lambda c, b: xor(c >> 8, step[1 + (xor(c, b) & 255)])), 4294967295)"

OP12 = f"""with t as (select list_transform(range(0, 256), lambda i: list_reduce([i::bigint] || range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as step),
r as (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
u as (select run, coalesce(doc_id::varchar, '') || ':' || run as x, count(*) as n from r where length(run) >= 6 group by 1, 2), h as (select run, n, {CRC} as h from u, t),
w as (select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, sum(n)::bigint as n from h group by 1 having length(word) >= 6 and sum(n) >= 5),
c as (select word, n, i, substr(word, 1, i::int) || substr(word, i::int + 2) as rest from (select word, n, unnest(range(0, length(word))) as i from w)), d as (select distinct c.word as a, w.word as b from c join w on w.word = c.rest),
p as (select c.word as a, e.word as b from c join c e on c.i = e.i and c.rest = e.rest and c.word <> e.word union select a, b from d union select b, a from d),
f as (select a, count(*) as n_near, first(b order by w.n desc, b) as form, first(w.n order by w.n desc, b) as form_n from p join w on w.word = p.b group by 1),
g as (select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when form_n >= 5 * w.n then form end as form, case when form_n >= 5 * w.n then form_n end as form_n from w left join f on f.a = w.word),
z as (with recursive up(word, root) as (select word, word from g union all select up.word, g.form from up join g on g.word = up.root where g.form is not null) select up.word, up.root from up join g on g.word = up.root where g.form is null)
select g.word, g.form, z.root, g.n, g.n_near, g.form_n from g join z using (word)"""

OP13 = """with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select r, doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i from d), k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
j as (select r, i, line, length(key) >= 10 and doc_id is distinct from min(doc_id) over (partition by key) as gone from k)
select d.doc_id, len(d.lines)::bigint as n_lines, x.n_dropped, sha256(x.kept) as kept_sha256 from d join (select r, count(*) filter (gone)::bigint as n_dropped, coalesce(string_agg(line, chr(10) order by i) filter (not gone), '') as kept from j group by 1) x using (r)"""

ORACLE_SQL = {"op5_embedding_near_dedup": OP5, "op8_warc_index_merge": OP8, "op9_minhash_near_dedup": OP9, "op12_spelling_variants": OP12, "op13_line_dedup": OP13}
