"""SQL for DuckDB with the same rows as the queries of this subpackage, where SQL has them."""

from __future__ import annotations

BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {}

ORACLES["op1_topk_search"] = """
with vectors as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from vectors q join vectors c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank,
           vec_id, score
    from scored)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 20
"""

ORACLES["op6_embedding_near_dedup"] = """
with recursive vectors as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b
      on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
     and list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) as (
    select vec_id, vec_id from embeddings
    union select reach.a, links.b from reach join links on reach.b = links.a)
select e.vec_id, (select count(*) from links where links.a = e.vec_id) as n_links,
       min(r.b) as component_id, e.vec_id = min(r.b) as kept
from embeddings e join reach r on r.a = e.vec_id group by e.vec_id
"""

ORACLES["op5_url_filter"] = f"""
with rules(verdict, host, path) as (values
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
urls as (
    select page_id,
           case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages),
parts as (
    select page_id, {LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} as host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from urls),
fitting as (
    select p.page_id, r.host || r.path as rule, r.verdict
    from parts p join rules r
      on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)),
best as (
    select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
    from fitting group by page_id)
select p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') as verdict
from parts p left join best b using (page_id)
"""

ORACLES["op8_sharding"] = """
with sized as (
    select doc_id, octet_length(encode(coalesce(text, ''))) as n_bytes,
           ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ' ' || coalesce(text, '')),
                           1, 15))::bigint as hash
    from documents),
nodes as (
    select depth, hash >> (60 - depth) as prefix, sum(n_bytes)::bigint as shard_bytes,
           count(*) as shard_docs
    from sized, range(0, 61) depths(depth) group by all),
leaves as (
    select depth, prefix, shard_bytes, shard_docs from nodes
    where (shard_bytes <= 1048576 or depth = 60)
      and (depth = 0 or exists (
          select 1 from nodes p
          where p.depth = nodes.depth - 1 and p.prefix = nodes.prefix >> 1
            and p.shard_bytes > 1048576)))
select s.doc_id, s.n_bytes,
       case when depth = 0 then '' else lpad(bin(prefix), depth::integer, '0') end as shard,
       depth::integer as depth, shard_bytes, shard_docs
from sized s join leaves l on s.hash >> (60 - l.depth) = l.prefix
"""

ORACLES["op10_line_dedup"] = f"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as number
    from documents),
keyed as (
    select *, {LOWER.format(f"trim(line, {BLANKS})")} as key from lines),
shared as (
    select key, max(doc_id) as last_doc from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3),
marked as (
    select k.*, s.key is not null and k.doc_id <> s.last_doc as gone
    from keyed k left join shared s on k.key = s.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by number) filter (not gone), ''))
           as kept_sha256
from marked group by doc_id
"""

TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(
    LOWER.format("coalesce(text, '')")
)

ORACLES["op11_ranked_search"] = f"""
with words as (select doc_id, unnest({TERMS}) as term from documents),
counts as (select doc_id, term, count(*) as tf from words group by all),
sizes as (select doc_id, sum(tf)::bigint as n from counts group by doc_id),
totals as (select count(*) as n_docs, sum(n)::bigint as n_terms from sizes),
asked as (select distinct item_id, unnest({TERMS}) as term from benchmark),
weights as (
    select a.term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(c.doc_id) + 1)))::bigint as w
    from (select distinct term from asked) a left join counts c using (term), totals
    group by a.term, n_docs),
scores as (
    select a.item_id, c.doc_id,
           sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::bigint
               as score
    from asked a join weights w using (term) join counts c using (term) join sizes using (doc_id), totals
    group by a.item_id, c.doc_id),
ranked as (
    select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
    from scores where score > 0)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 10
"""

# CRC-32 of the decimal text of a whole number: eight steps for each byte.
CRC32 = """xor(list_reduce(
    list_concat([4294967295::bigint],
                list_transform(string_split({0}::varchar, ''), lambda c: ord(c)::bigint)),
    lambda a, x: list_reduce(list_concat([xor(a, x)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                             lambda p, q: xor(p >> 1, 3988292384::bigint * (p & 1)))),
    4294967295)"""

ORACLES["op12_conversation_trie"] = f"""
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first) as pos
    from conversations where conv_id is not null),
convs as (
    select conv_id, count(*) as n, {CRC32.format("conv_id")} % 4 as h,
           conv_id - conv_id % 20 as base
    from turns group by conv_id),
rebuilt as (
    select c.conv_id, t.pos as depth, t.role, t.text
    from convs c join turns t on t.conv_id = c.base and t.pos <= c.h
    union all
    select c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.role, t.text
    from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h
    left join convs b on b.conv_id = c.base),
paths as (
    select conv_id, 0 as depth, '' as path, 0 as words from convs
    union all
    select conv_id, depth,
           string_agg(sha256(length(role)::varchar || ':' || role || text), '')
               over (partition by conv_id order by depth),
           len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))
    from rebuilt),
lengths as (select conv_id, max(depth) as length from paths group by conv_id),
nodes as (
    select depth, path, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words
    from paths group by depth, path),
children as (
    select depth - 1 as depth, left(path, length(path) - 64) as path, count(*) as n_children
    from nodes where depth > 0 group by all),
sized as (
    select n.*, coalesce(c.n_children, 0) as n_children
    from nodes n left join children c on c.depth = n.depth and c.path = n.path),
totals as (
    select a.depth, a.path, count(*) filter (b.n_children = 0) as n_leaves,
           sum((b.n_convs - 1) * b.words)::bigint as saved_tokens
    from sized a join sized b on starts_with(b.path, a.path) group by a.depth, a.path),
ends as (
    select p.depth, p.path, sha256(string_agg(p.conv_id::varchar, ',' order by p.conv_id)) as sha
    from paths p join lengths l on l.conv_id = p.conv_id and l.length = p.depth
    group by p.depth, p.path)
select n.conv_id, n.depth::bigint as depth, u.conv_id as parent_conv_id, n.n_convs, n.n_children,
       t.n_leaves, t.saved_tokens, coalesce(e.sha, sha256('')) as ends_sha256
from sized n join totals t on t.depth = n.depth and t.path = n.path
left join nodes u on u.depth = n.depth - 1 and u.path = left(n.path, length(n.path) - 64)
left join ends e on e.depth = n.depth and e.path = n.path
"""

ORACLES["op13_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""
