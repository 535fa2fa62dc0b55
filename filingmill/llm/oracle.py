"""What the queries must return, as SQL for DuckDB over the supplied tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op10_url_filter"] = r"""
with urls as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest,
    url is not null and strpos(url, '://') > 0 has
  from pages),
split as (
  select page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path
  from urls),
outcome as (
  select doc_id, max(case when toxic = 1 or quality = 0 then 1 else 0 end) bad
  from labels where toxic is not null or quality is not null group by doc_id),
named as (
  select s.*, o.bad, string_split(host, '.') labels_ from split s left join outcome o on o.doc_id = s.page_id),
counts as (
  select host, any_value(labels_[-1]) suffix,
    any_value(case when len(labels_) > 1 then labels_[-2] || '.' || labels_[-1] else host end) dom,
    count(bad)::double n, coalesce(sum(bad), 0)::double k
  from named group by host),
overall as (select (sum(k) + 0.5) / (sum(n) + 1) mean from counts),
s1 as (select suffix, sum(n) n, sum(k) k from counts group by suffix),
w1 as (
  select case when sum(n) > 0 and sum((k - n * mean) ** 2 / n) > sum(mean * (1 - mean))
    then least(greatest(sum(n * mean * (1 - mean)) / (sum((k - n * mean) ** 2 / n) - sum(mean * (1 - mean))) - 1, 1), 1000)
    else 1000 end w from s1, overall where n > 0),
p1 as (select suffix, (w * mean + k) / (w + n) mean from s1, overall, w1),
s2 as (select c.suffix, dom, sum(n) n, sum(k) k, any_value(mean) mean from counts c join p1 using (suffix) group by all),
w2 as (
  select case when sum(n) > 0 and sum((k - n * mean) ** 2 / n) > sum(mean * (1 - mean))
    then least(greatest(sum(n * mean * (1 - mean)) / (sum((k - n * mean) ** 2 / n) - sum(mean * (1 - mean))) - 1, 1), 1000)
    else 1000 end w from s2 where n > 0),
p2 as (select suffix, dom, (w * mean + k) / (w + n) mean from s2, w2),
s3 as (select c.host, c.n, c.k, p2.mean from counts c join p2 using (suffix, dom)),
w3 as (
  select case when sum(n) > 0 and sum((k - n * mean) ** 2 / n) > sum(mean * (1 - mean))
    then least(greatest(sum(n * mean * (1 - mean)) / (sum((k - n * mean) ** 2 / n) - sum(mean * (1 - mean))) - 1, 1), 1000)
    else 1000 end w from s3 where n > 0),
p3 as (select host, (w * mean + k) / (w + n) mean, w + n size from s3, w3),
rules(verdict, rhost, rpath) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits as (
  select s.page_id, max_by(rhost || rpath, length(rhost || rpath)) rule, max_by(r.verdict, length(rhost || rpath)) verdict
  from split s join rules r on (s.host = rhost or ends_with(s.host, '.' || rhost)) and starts_with(s.path, rpath)
  group by s.page_id)
select s.page_id, s.host, s.path, f.rule,
  coalesce(f.verdict, case when p3.mean - 1.645 * sqrt(p3.mean * (1 - p3.mean) / (p3.size + 1)) > 0.25 then 'block' else 'allow' end) verdict
from split s left join p3 using (host) left join fits f using (page_id)
"""

SQL["op9_nearest"] = """
with usable as (
  select vec_id, embedding::double[] v from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (
  select q.vec_id query_id, c.vec_id, list_dot_product(q.v, c.v) score
  from usable q join usable c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
ranked as (select *, (row_number() over (partition by query_id order by score desc, vec_id))::int rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

# Words between ASCII white space in lower case as to A-Z; runs of three, or all if fewer; components
# by following links to their ends.
SQL["op6_jaccard_join"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws
  from documents),
grams as (
  select distinct doc_id, unnest(case when len(ws) between 1 and 2 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) end) gram
  from words),
sizes as (select doc_id, count(*) n from grams group by doc_id),
met as (
  select a.doc_id a, b.doc_id b, count(*) o
  from grams a join grams b on a.gram = b.gram and a.doc_id < b.doc_id group by all),
links as (
  select a, b from met join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * o >= 90 * (x.n + y.n - o)),
edges as (select a, b from links union all select b, a from links),
reached as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, e.b from reached r join edges e on r.other = e.a)
select r.doc_id, coalesce(any_value(s.n), 0) n_shingles, min(r.other) component_id
from reached r left join sizes s on s.doc_id = r.doc_id group by r.doc_id
"""

# Windows of ten words, or whole items if shorter, looked up among the runs of so many words of a text.
SQL["op7_decontaminate"] = r"""
with words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from documents),
items as (
  select item_id::varchar item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from benchmark),
phrases as (
  select distinct item_id, least(len(ws), 10) size,
    unnest(list_transform(range(1, greatest(len(ws) - 10, 0) + 2),
      lambda i: array_to_string(ws[i:i + least(len(ws), 10) - 1], ' '))) phrase
  from items where len(ws) > 0),
runs as (
  select doc_id, size, start, array_to_string(ws[start:start + size - 1], ' ') phrase
  from (select doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) start
        from words, (select distinct size from phrases))),
found as (select doc_id, item_id, start, r.size from runs r join phrases p on p.phrase = r.phrase and p.size = r.size),
hits as (
  select doc_id, count(distinct place) n_hit
  from (select doc_id, unnest(range(start, start + size)) place from found) group by doc_id),
held as (
  select doc_id, count(distinct item_id) n_items, string_agg(distinct item_id, ',' order by item_id) ids
  from found group by doc_id)
select doc_id, len(ws) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from words left join hits using (doc_id) left join held using (doc_id)
"""

# Base32 writes five hexadecimal digits as four characters.
SQL["op8_warc"] = """
with payloads as (
  select page_id, coalesce(html, '') payload, sha1(coalesce(html, '')) hex from pages),
first as (select payload, min(page_id) original from payloads group by payload)
select page_id, octet_length(encode(payload)) payload_bytes,
  array_to_string(list_transform(range(0, 32),
    lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(hex, 5 * (k // 4) + 1, 5))::integer >> (15 - 5 * (k % 4))::integer) & 31) + 1), 1)), '') payload_digest,
  case when page_id = original then 'response' else 'revisit' end record_type,
  case when page_id <> original then original end refers_to
from payloads join first using (payload)
"""

# Prefixes are told apart by a digest of the digests of their turns; a node's subtree is all that some
# member of it goes through from its depth on.
SQL["op11_prefix_trie"] = """
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) pos
  from conversations where conv_id is not null),
sizes as (select conv_id, count(*) n from own group by conv_id),
convs as (
  select s.conv_id, s.conv_id - s.conv_id % 5 base, h, least(h, coalesce(b.n, 0)) taken,
    least(h, coalesce(b.n, 0)) + greatest(s.n - h, 0) size
  from (select *, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda ch: ord(ch)::bigint)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 h
    from sizes) s left join sizes b on b.conv_id = s.conv_id - s.conv_id % 5),
rebuilt as (
  select c.conv_id, o.pos depth, c.size, o.role, o.text from convs c join own o on o.conv_id = c.base and o.pos <= c.taken
  union all
  select c.conv_id, c.taken + o.pos - c.h, c.size, o.role, o.text from convs c join own o on o.conv_id = c.conv_id and o.pos > c.h),
ways as (
  select conv_id, depth, size, octet_length(encode(text)) bytes,
    md5(string_agg(md5(octet_length(encode(role)) || ':' || role || text), '' order by depth) over (partition by conv_id order by depth)) prefix
  from rebuilt
  union all
  select conv_id, 0, size, 0, '' from convs),
nodes as (
  select prefix, depth, min(conv_id) conv_id, count(*) n_convs, max(bytes) bytes,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = size), '')) ends_sha256
  from ways group by prefix, depth),
edges as (
  select n.prefix, n.depth, p.prefix parent, p.conv_id parent_conv_id
  from nodes n left join ways w on w.conv_id = n.conv_id and w.depth = n.depth - 1
    left join nodes p on p.prefix = w.prefix and p.depth = w.depth),
grown as (
  select n.*, e.parent_conv_id, (select count(*) from edges c where c.parent = n.prefix and c.depth = n.depth + 1) n_children
  from nodes n join edges e using (prefix, depth)),
below as (
  select t.prefix, t.depth, count(*) filter (u.n_children = 0) n_leaves, sum((u.n_convs - 1) * u.bytes) saved_tokens
  from grown u join ways t on t.conv_id = u.conv_id and t.depth <= u.depth group by t.prefix, t.depth)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::bigint saved_tokens, ends_sha256
from grown join below using (prefix, depth)
"""
