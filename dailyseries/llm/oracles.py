"""DuckDB SQL of the operators whose own modules don't hold it."""

from __future__ import annotations

from dailyseries.llm import pii

MINHASH = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (
  select distinct doc_id, sh from (
    select doc_id, unnest([ws[i:i + 3] for i in range(1, greatest(2, len(ws) - 2))]) as sh from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as i from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id
  group by 1, 2),
link as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 80 * (x.n + y.n - i)),
reach(doc_id, near) as (
  select doc_id, doc_id from documents union select r.doc_id, link.b from reach r join link on link.a = r.near),
c as (select doc_id, min(near) as component_id from reach group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from c left join n using (doc_id)
"""

SUFFIX_DEDUP = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
blocks as (
  select doc_id, o, substr(h, 2 * o + 1, 1398) as h from (
    select doc_id, h, unnest(range(0, len(h) // 2, 500)) as o from d)),
w as (
  select doc_id, o + s as s, md5(substr(h, 2 * s + 1, 400)) as k from (
    select doc_id, o, h, unnest(range(0, len(h) // 2 - 199)) as s from blocks)),
dup as (select k from w group by k having count(*) > 1),
hit as (select doc_id, s from w join dup using (k)),
mark as (
  select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 200 then 0 else 1 end as fresh from hit),
isle as (
  select doc_id, min(s) as a, max(s) + 200 as b
  from (select *, sum(fresh) over (partition by doc_id order by s) as g from mark) group by doc_id, g),
piece as (
  select doc_id, a, substr(h, 2 * coalesce(lag(b) over (partition by doc_id order by a), 0) + 1,
    2 * (a - coalesce(lag(b) over (partition by doc_id order by a), 0))) as p from isle join d using (doc_id)),
cut as (select doc_id, string_agg(p, '' order by a) as p from piece group by doc_id),
tot as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans, max(b) as tail from isle group by doc_id)
select doc_id, len(h) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(p, '') || substr(h, 2 * coalesce(tail, 0) + 1))) as kept_sha256
from d left join tot using (doc_id) left join cut using (doc_id)
"""

# fixed values: the base patterns as the contract gives them
_BASE = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    r"[0-9](?:[\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
_COUNTS = ["n_email", "n_ip", "n_card", "n_phone", "n_term"]


def _pieces(table: str, kind: int, pattern: str) -> str:
    return (f"select doc_id, {kind} as kind, unnest(h) as hit, unnest(g[1:len(h)]) as gap, unnest(range(len(h))) as i "
            f"from (select doc_id, regexp_extract_all(t, '{pattern}') as h, string_split_regex(t, '{pattern}') as g "
            f"from {table})")


def _masked() -> str:
    out = "t"
    for p in _BASE:
        out = f"regexp_replace({out}, '{p}', ' ', 'g')"
    return out


PII = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
hits as ({' union all '.join(_pieces('d', k, p) for k, p in enumerate(_BASE))}),
placed as (select *, sum(len(gap) + len(hit)) over (partition by doc_id, kind order by i) as e,
  regexp_replace(hit, '[^0-9]', '', 'g') as digits from hits),
base as (select doc_id, kind, e - len(hit) as s, e, hit, digits from placed where case kind when 0 then true
  when 1 then regexp_full_match(hit, '{pii._BYTE}(?:\\.{pii._BYTE}){{3}}')
  when 2 then len(digits) between 16 and 19 and list_sum([
    case when (len(digits) - j) % 2 = 0 then cast(digits[j] as int)
      when cast(digits[j] as int) > 4 then 2 * cast(digits[j] as int) - 9 else 2 * cast(digits[j] as int) end
    for j in range(1, len(digits) + 1)]) % 10 = 0
  else len(digits) between 8 and 15 end),
ent as (select distinct doc_id, kind || ':' || case kind when 0 then translate(hit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') when 1 then hit else digits end as x from base),
often as (select x, count(*) as n_e from ent group by x having count(*) >= {pii.MIN_SUPPORT}),
word as (select doc_id, term from (
  select doc_id, unnest(list_distinct(string_split_regex(lower({_masked()}), '[^\\p{{L}}\\p{{N}}]+'))) as term from d)
  where len(term) >= {pii.MIN_TERM}),
pair as (select term, x, n_e, count(*) as n_te from ent join often using (x) join word using (doc_id)
  group by term, x, n_e having count(*) >= {pii.MIN_SUPPORT}),
n_t as (select term, count(*) as n_t from word where term in (select term from pair) group by term),
total as (select cast(count(*) as double) as n from d),
term as (select term from pair join n_t using (term), total where n_e < n group by term
  having max(ln(n_te * n / (n_t * n_e)) / ln(n / n_e)) >= {pii.THRESHOLD}),
own as (select doc_id, term from word join term using (term)),
near as (select d.* from d where doc_id in (select doc_id from own)),
tok as ({_pieces('near', 4, '[\\p{L}\\p{N}]+')}),
tokp as (select *, sum(len(gap) + len(hit)) over (partition by doc_id order by i) as e from tok),
added as (select tokp.doc_id, 4 as kind, e - len(hit) as s, e from tokp
  join own on own.doc_id = tokp.doc_id and own.term = lower(hit)
  where not exists (select 1 from base b where b.doc_id = tokp.doc_id and b.s < tokp.e and tokp.e - len(tokp.hit) < b.e)),
spans as (select doc_id, kind, s, e from base union all select doc_id, kind, s, e from added),
txt as (select doc_id, kind, s, (['email', 'ip', 'card', 'phone', 'term'])[kind + 1] || ':' || cast(s as bigint) || ':'
  || cast(e as bigint) as x from spans),
agg as (select doc_id, string_agg(x, ',' order by kind, s) as spans,
  string_agg(x, ',' order by kind, s) filter (where kind < 4) as base,
  {', '.join(f"count(*) filter (where kind = {k}) as {n}" for k, n in enumerate(_COUNTS))}
  from txt group by doc_id)
select doc_id, {', '.join(f"coalesce({n}, 0) as {n}" for n in _COUNTS)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join agg using (doc_id)
"""


def _least(*options: str) -> str:
    return f"least({', '.join(options)})"


def _edit(letter: str, state: str, cost: str, when: str = "true") -> str:
    return f"case when {when} then {{'c': {state}.c + {cost}, 'a': '{letter}' || {state}.a}} end"


def _row_step() -> str:
    """Cheapest way on from each state over one row, before inserts."""
    to = {"q0": ("q2", [("s", "q1"), ("u", "q2")]), "q1": ("q2", [("u", "q2")]), "q2": ("q3", [("a", "q3")]),
          "q3": ("q2", [("u", "q2")])}
    return ", ".join(_least(_edit("D", q, "4"), *[_edit("K", k, "more", f"stays and r = '{r}'") for r, k in kept],
                            _edit("R", asked, "3 + more", "stays")) + f" as b{q[1]}" for q, (asked, kept) in to.items())


CONVERSATIONS = rf"""
with recursive tbl as (
  select list_transform(range(256), lambda i: list_reduce([cast(i as ubigint)] || cast(range(8) as ubigint[]),
    lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as t),
raw as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, list_transform(string_split(
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
    lambda c: cast(ord(c) as ubigint)) as k from conversations),
crc as (
  select raw.*, xor(list_reduce([cast(4294967295 as ubigint)] || k, lambda a, b: xor(a >> 8, t[cast((xor(a, b) & 255) + 1 as bigint)])),
    4294967295) % 20 as h from raw, tbl),
hit as (
  select conv_id, turn, case when h = 4 then 'user' else role end as role,
    case when h = 1 then '' when h = 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case h when 0 then 0 when 3 then 2 else 1 end)) as copy from crc),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i,
    left(role, 1) as r, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) as tail from hit),
faults as (
  select *, tail = '' as blank,
    tail <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as dup,
    lag(r) over (partition by conv_id order by i) || r as pair from placed),
row as (
  select *, not blank and not dup and tail not in ('.', '!', '?') as cut, not blank and not dup as stays,
    case when not blank and not dup and tail not in ('.', '!', '?') then 3 else 0 end as more from faults),
ids as (select distinct conv_id from conversations),
counts as (
  select ids.conv_id, count(i) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where blank) as blank, count(*) filter (where dup) as duplicate,
    count(*) filter (where cut) as truncated,
    count(*) filter (where pair is not null and pair not in ('su', 'ua', 'au')) as illegal
  from ids left join row on row.conv_id is not distinct from ids.conv_id group by ids.conv_id),
back as (
  select conv_id, n as i, {{'c': cast(0 as bigint), 'a': ''}} as q0, {{'c': cast(6 as bigint), 'a': 'II'}} as q1,
    {{'c': cast(3 as bigint), 'a': 'I'}} as q2, {{'c': cast(0 as bigint), 'a': ''}} as q3 from counts
  union all
  select conv_id, i, {_least('b0', _edit('I', 'u', '3'))}, {_least('b1', _edit('I', 'u', '3'))}, u, a from (
    select *, {_least('b2', _edit('I', 'b3', '3'))} as u, {_least('b3', _edit('I', 'b2', '3'))} as a from (
      select back.conv_id, back.i - 1 as i, {_row_step()}
      from back join row on row.conv_id is not distinct from back.conv_id and row.i = back.i))),
best as (select conv_id, q0.c as cost, q0.a as audit from back where i = 0),
letters as (
  select conv_id, p, audit[p] as e from (
    select conv_id, audit, unnest(range(1, length(audit) + 1)) as p from best)),
numbered as (
  select *, sum(case when e = 'I' then 0 else 1 end) over (partition by conv_id order by p) as i from letters),
lines as (
  select l.conv_id, l.p, l.e, row.role, row.text, l.e = 'K' and row.r = 's' as first
  from numbered l left join row on row.conv_id is not distinct from l.conv_id and row.i = l.i and l.e <> 'I'
  where l.e <> 'D'),
turned as (
  select *, sum(case when first then 0 else 1 end) over (partition by conv_id order by p) % 2 as odd from lines),
said as (
  select conv_id, p, case when e = 'K' then role when odd = 1 then 'user' else 'assistant' end || ':'
    || case when e = 'I' then '' else text end as line from turned),
digest as (select conv_id, sha256(string_agg(line, chr(10) order by p)) as d from said group by conv_id)
select c.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, b.cost, b.audit,
  coalesce(d.d, sha256('')) as repaired_sha256
from counts c join best b on b.conv_id is not distinct from c.conv_id
left join digest d on d.conv_id is not distinct from c.conv_id
"""
