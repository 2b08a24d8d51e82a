"""The results of the operators in SQL for DuckDB, where SQL can say them."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _crc32(text: str) -> str:
    """CRC-32 of a short ASCII string: a byte is eight shifts."""
    return (
        f"xor(list_reduce([4294967295::bigint] || list_transform(string_split({text}, ''), lambda c: ord(c)::bigint), "
        "lambda r, b: list_reduce([xor(r, b)] || range(8), lambda v, k: case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)), 4294967295::bigint)"
    )


REPEATS = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
g as (select r, doc_id, i, array_to_string(w[i:i + 12], ' ') as gram from (select *, unnest(range(1, len(w) - 11)) as i from d where len(w) >= 13)),
f as (select gram, min(doc_id) as first from g group by gram),
hit as (select distinct r, p from (select r, unnest(range(i, i + 13)) as p from g join f using (gram) where first < doc_id)),
k as (select r, p, word from (select r, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from d) anti join hit using (r, p)),
t as (select r, count(*) as n, string_agg(word, ' ' order by p) as kept from k group by r)
select doc_id, len(w)::bigint as n_words, len(w)::bigint - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join t using (r)
"""

SIMILAR = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + n - 1], ' ') as gram
      from (select doc_id, w, least(5, len(w)) as n, unnest(range(1, len(w) - least(5, len(w)) + 2)) as i from d where len(w) > 0)),
c as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b using (gram) where a.doc_id < b.doc_id group by all),
l as (select a, b from p join c x on x.doc_id = a join c y on y.doc_id = b where 100 * shared >= 80 * (x.n + y.n - shared)),
e as (select a, b from l union all select b, a from l),
reach as (select doc_id as x, doc_id as y from d union select x, b from reach join e on y = a),
least_id as (select x as doc_id, min(y) as component_id from reach group by x)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id from d left join c using (doc_id) join least_id using (doc_id)
"""

_NONE = "{'c': 1000000000::bigint, 'a': '', 'l': []::varchar[]}"
_END = "{'c': 0::bigint, 'a': '', 'l': []::varchar[]}"


def _put(to: str, way: str, letter: str, cost: str, line: str) -> str:
    return f"{{'c': {way}.c + {cost}, 'a': '{letter}' || {way}.a, 'l': {'[' + line + '] || ' if line else ''}{way}.l}}" + (f" as {to}" if to else "")


def _closed(e: str, s: str, u: str, a: str) -> str:
    """States (as columns e, s, u, a) once empty texts may be put in."""
    after_u, after_a = _put("", a, "I", "3", "'assistant:'"), _put("", u, "I", "3", "'user:'")
    best_u = f"list_min([{u}, {after_u}])"
    return f"{best_u} as u, list_min([{a}, {after_a}]) as a, list_min([{e}, {_put('', best_u, 'I', '3', chr(39) + 'user:' + chr(39))}]) as e, list_min([{s}, {_put('', best_u, 'I', '3', chr(39) + 'user:' + chr(39))}]) as s"


def _row(state: str, kept: str, need: str) -> str:
    """What a row makes of a state: deleted, kept if its role may follow, or given the next role."""
    line = "role || ':' || text"
    keep = " ".join(f"when initial = '{i}' then {_put('', f'rec.{to}', 'K', 'more', line)}" for i, to in kept.items() if i)
    role = {"u": "user", "a": "assistant"}[need]
    gone = "('blank', 'duplicate')"
    rerole = _put("", f"rec.{need}", "R", "3 + more", f"'{role}:' || text")
    return f"list_min([{_put('', f'rec.{state}', 'D', '4', '')}, case when fault in {gone} then {_NONE} {keep} else {_NONE} end, case when fault in {gone} then {_NONE} else {rerole} end]) as {state}"


REPAIR = rf"""
with recursive src as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as hit from conversations),
dam as (select conv_id, turn, case when hit = 4 then 'user' else role end as role,
    case hit when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when hit = 3 then 2 else 1 end)) as k from src where hit <> 0),
num as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), k) as i, left(role, 1) as initial from dam),
rows as (select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
    when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' end as fault,
    lag(initial) over (partition by conv_id order by i) || initial as pair from num),
counts as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
    count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated, count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
    from rows group by conv_id),
ids as (select distinct conv_id from conversations),
rec as (
  select conv_id, coalesce(n, 0) + 1 as i, {_closed("x.e", "x.s", "x.u", "x.a")}
    from ids left join counts using (conv_id), (select {_END} as e, {_NONE} as s, {_NONE} as u, {_END} as a) x
  union all
  select conv_id, i, {_closed("w.e", "w.s", "w.u", "w.a")} from (
    select conv_id, q.i, {_row("e", {"s": "s", "u": "u"}, "u")}, {_row("s", {"u": "u"}, "u")}, {_row("u", {"a": "a"}, "a")}, {_row("a", {"u": "u"}, "u")}
    from rec join (select *, case when fault = 'truncated' then 3 else 0 end as more from rows) q using (conv_id) where q.i = rec.i - 1) w)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  e.c as cost, e.a as audit, sha256(array_to_string(e.l, chr(10))) as repaired_sha256
from rec left join counts using (conv_id) where rec.i = 1
"""

TRIE = rf"""
with own as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, name) as i, name, words from (
    select conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as name,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words from conversations where conv_id is not null)),
ids as (select c, {_crc32("c::varchar")} % 4 as h from (select distinct c from own)),
turns as (select ids.c, 0 as tail, i, name, words from ids join own on own.c = ids.c - ids.c % 20 where i <= h
    union all select c, 1, i, name, words from ids join own using (c) where i > h),
placed as (select c, row_number() over w as d, string_agg(name, '') over w as p, words from turns
    window w as (partition by c order by tail, i rows between unbounded preceding and current row)),
m as (select c, d, p, words from placed union all select c, 0, '', 0 from ids),
long as (select *, d = max(d) over (partition by c) as ends from m),
node as (select p, any_value(d) as depth, min(c) as conv_id, count(*) as n, any_value(words) as words,
    coalesce(string_agg(c::varchar, ',' order by c) filter (where ends), '') as ends from long group by p),
kids as (select left(p, length(p) - 64) as p, count(*) as k from node where depth > 0 group by 1),
sub as (select left(p, 64 * u) as p, count(*) filter (where k is null) as leaves, sum((n - 1) * words) as saved
    from (select *, unnest(range(depth + 1)) as u from node left join kids using (p)) group by 1)
select node.conv_id, node.depth, up.conv_id as parent_conv_id, node.n as n_convs, coalesce(k, 0) as n_children, leaves as n_leaves, saved::bigint as saved_tokens, sha256(node.ends) as ends_sha256
from node join sub using (p) left join kids using (p) left join node up on node.depth > 0 and up.p = left(node.p, length(node.p) - 64)
"""


def _item_words(table: str) -> str:
    return rf"list_filter(string_split_regex(translate(coalesce({table}.text, ''), {_AZ}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w"


CONTAMINATION = rf"""
with d as (select row_number() over () as r, doc_id, {_item_words("documents")} from documents),
b as (select item_id, {_item_words("benchmark")} from benchmark),
g as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as gram
      from (select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
h as (select r, i, n, gram from (select r, i, n, array_to_string(w[i:i + n - 1], ' ') as gram
      from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from g) where len(w) >= n)) semi join g using (n, gram)),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from h) group by r),
held as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items
      from (select distinct r, coalesce(item_id::varchar, '') as item from h join g using (n, gram)) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from d left join hit using (r) left join held using (r)
"""
