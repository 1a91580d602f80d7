"""DuckDB SQL that checks the training-data queries, written apart from their code."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Words: runs of characters other than blank and \x09-\x0D.
_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op3_urls"] = f"""
with rules(rule, host, path, verdict) as (values
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
after as (
  select page_id, html, url, strpos(coalesce(url, ''), '://') as p, substr(url, strpos(url, '://') + 3) as rest from pages),
cut as (
  select page_id, html, url, case when p = 0 then '' else {_ASCII_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} end as host,
         case when p = 0 then '' else regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) end as path,
         case when p = 0 then '' else regexp_extract(rest, '^[^?#]*([?][^#]*)', 1) end as search
  from after),
judged as (
  select c.page_id, c.host, c.path, first(r.rule order by length(r.rule) desc) as rule,
         first(r.verdict order by length(r.rule) desc) as verdict
  from (select page_id, host, path, row_number() over () as n from cut) c
  left join rules r on (c.host = r.host or ends_with(c.host, '.' || r.host)) and starts_with(c.path, r.path)
  group by c.n, c.page_id, c.host, c.path)
-- no page of the given tables links to another one, so each is alone in its component
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict, cast(null as varchar) as alias_of from judged
"""

ORACLE["op5_chat"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
placed as (
  select *, coalesce(lag(role) over w, '') as before from turns
  window w as (partition by conv_id order by turn nulls first, role, text))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
  -- per turn: the role, its text with one more character for each control mark, and 24 characters of template
  cast(sum(length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 24) as bigint) as formatted_chars,
  bool_and(before = '' and role in ('system', 'user') or before in ('system', 'assistant') and role = 'user'
           or before = 'user' and role = 'assistant') as valid
from placed group by conv_id
"""

ORACLE["op8_quality"] = f"""
with d as (
  select row_number() over () as n, doc_id, coalesce(source, '') as host, coalesce(text, '') as text from documents),
w as (select *, {_WORDS.format("text")} as words from d),
windows as (
  select n, i, array_to_string(words[i:i + 7], ' ') as win
  from (select n, words, unnest(range(1, len(words) - 6)) as i from w)),
often as (select n, i from windows qualify count(*) over (partition by n, win) > 1),
repeated as (select n, count(distinct j) as r from (select n, unnest(range(i, i + 8)) as j from often) group by n),
lines as (
  select n, host, pos, line, array_to_string({_WORDS.format(_ASCII_LOWER.format("line"))}, ' ') as norm
  from (select n, host, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from d)),
dup as (select n, count(*) - count(distinct line) as dups from lines where norm <> '' group by n),
frequent as (
  select l.host, l.norm from (select host, norm, count(distinct n) as c from lines where norm <> '' group by all) l
  join (select host, count(*) as docs from d group by host) h using (host) where l.c > 10 and l.c > 0.01 * h.docs),
remaining as (
  select l.n, sum(len({_WORDS.format("l.line")})) as n_left from lines l
  left join frequent f on l.host = f.host and l.norm = f.norm where f.norm is null group by l.n),
base as (
  select w.n, doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    coalesce(dups, 0) as n_dup_lines, coalesce(r, 0) as n_repeat_words, coalesce(n_left, 0) as n_left
  from w left join dup using (n) left join repeated using (n) left join remaining using (n))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and n_left >= 0.3 * n_words as kept
from base
"""

ORACLE["op10_substrings"] = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
starts as (
  select doc_id, i, substr(h, 2 * i + 1, 100) as s
  from (select doc_id, h, unnest(range(0, length(h) // 2 - 49)) as i from d)),
hit as (select doc_id, i from starts qualify min(doc_id) over (partition by s) < doc_id),
marked as (
  select doc_id, i, max(i) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) as p from hit),
runs as (
  select doc_id, i, sum(case when p is null or i > p + 50 then 1 else 0 end) over (partition by doc_id order by i) as run from marked),
gone as (select doc_id, run, min(i) as b, max(i) + 50 as e from runs group by all),
spans as (select doc_id, list(b order by b) as bs, list(e order by b) as es, sum(e - b) as n, count(*) as k from gone group by all)
select d.doc_id, length(h) // 2 as n_bytes, cast(coalesce(n, 0) as bigint) as n_removed,
  coalesce(k, 0) as n_spans,
  sha256(unhex(case when k is null then h else array_to_string(list_transform(range(1, k + 2), lambda j:
    substr(h, 2 * (case when j = 1 then 0 else es[j - 1] end) + 1,
           2 * ((case when j = k + 1 then length(h) // 2 else bs[j] end) - (case when j = 1 then 0 else es[j - 1] end)))), '') end)) as kept_sha256
from d left join spans using (doc_id)
"""

ORACLE["op7_jaccard"] = f"""
with recursive d as (
  select row_number() over () as n, doc_id, {_WORDS.format(_ASCII_LOWER.format("coalesce(text, '')"))} as w from documents),
sets as (
  select n, doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from d),
grams as (select n, len(s) as size, unnest(s) as g from sets),
often as (select * from grams qualify count(*) over (partition by g) > 1),
links as (
  select a.n as a, b.n as b from often a join often b on a.g = b.g and a.n <> b.n
  group by a.n, b.n, a.size, b.size having 100 * count(*) >= 80 * (a.size + b.size - count(*))),
reach(a, b) as (select n, n from d union select r.a, l.b from reach r join links l on r.b = l.a)
select s.doc_id, len(s.s) as n_shingles, min(t.doc_id) as component_id
from sets s join reach r on s.n = r.a join sets t on r.b = t.n group by s.n, s.doc_id, s.s
"""

ORACLE["op12_topk"] = """
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.r, q.vec_id as query_id, c.r as other, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.r <> c.r where q.vec_id % 50 = 0)
select query_id, cast(row_number() over w as integer) as rank, vec_id, score from scored
window w as (partition by r order by score desc, vec_id nulls last, other)
qualify row_number() over w <= 5
"""

# crc32 bit by bit: h starts as all ones and takes each bit of the digits, lowest first
ORACLE["op13_runs"] = f"""
with d as (
  select row_number() over () as r, doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
coded as (
  select r, doc_id, w, len(w) as n, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(8 * length(cast(doc_id as varchar))),
      lambda i: (ascii(substr(cast(doc_id as varchar), i // 8 + 1, 1)) >> (i % 8)) & 1)),
    lambda h, b: xor(h >> 1, 3988292384 * (xor(h, b) & 1)))) as h
  from d),
planted as (select *, h // 10 as g, case when h % 10 = 0 and n > 0 then (h // 10) % n end as a from coded),
periods as (select *, 1 + (n - a) // (3 + g % 8) as p from planted),
texts as (
  select r, doc_id, n, case when a is null then w else list_transform(range(n), lambda i:
    case when i >= a then w[a + (i - a) % p + 1] else w[i + 1] end) end as w from periods),
words as (select r, n, unnest(w) as word, unnest(range(n)) as i from texts),
equal as (select x.r, x.i, y.i - x.i as p from words x join words y on x.r = y.r and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n),
islands as (select r, p, i, i - row_number() over (partition by r, p order by i) as k from equal),
stretches as (select r, p, min(i) as s, count(*) + p as len from islands group by r, p, k having count(*) + p >= greatest(6, 4 * p)),
found as (select r, s, len, min(p) as q from stretches group by r, s, len),
best as (select * from found qualify row_number() over (partition by r order by cast(len as double) / q desc, s, q) = 1),
listed as (select r, count(*) as n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) as runs from found group by r),
dropped as (select distinct r, unnest(range(s + q, s + len)) as i from found),
kept as (
  select r, string_agg(word, ' ' order by i) as text from words anti join dropped using (r, i) group by r)
select t.doc_id, coalesce(n_runs, 0) as n_runs, s as start, len as length, q as period, 1000 * len // q as exponent_milli,
  sha256(coalesce(runs, '')) as runs_sha256, sha256(coalesce(text, '')) as collapsed_sha256
from texts t left join listed using (r) left join best using (r) left join kept using (r)
"""
