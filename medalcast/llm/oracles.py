"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

from . import quality_rules as qr

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UP}', '{_LOW}'), '{pattern}')"


# ---- op3: all pairs that share a shingle, then the closure of the links ----

OP3 = f"""
with recursive w as (select doc_id, {_words('text', _SPACED)} as ws from documents),
sh as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as s from w),
n as (select doc_id, count(*) as n from sh group by doc_id),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (select x, y from shared join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 85 * (p.n + q.n - c)),
either as (select x, y from links union all select y, x from links),
reach(doc_id, r) as (
  select doc_id, doc_id from documents
  union
  select reach.doc_id, e.y from reach join either e on e.x = reach.r
)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, min(reach.r) as component_id, d.doc_id = min(reach.r) as kept
from documents d left join n using (doc_id) join reach using (doc_id) group by d.doc_id, n.n
"""

# ---- op2: exact repeats by a window, near ones among lines that share half a line ----

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP2 = f"""
with l as (select doc_id, no - 1 as no, trim(x, {_BLANKS}) as line
           from (select doc_id, unnest(xs) as x, generate_subscripts(xs, 1) as no
                 from (select doc_id, string_split(coalesce(text, ''), chr(10)) as xs from documents))
           where trim(x, {_BLANKS}) <> ''),
o as (select *, row_number() over (partition by line order by doc_id, no) as nth, length(line) as n from l),
k as (select doc_id, no, line, n, m, side, case side when 'f' then substr(line, 1, m // 2) else right(line, m // 2) end as part
      from (select *, unnest([n, n - 1]) as m from o where nth = 1 and n >= 23) cross join (values ('f'), ('e')) s(side)),
p as (select distinct a.doc_id, a.no, a.line as x, b.line as y
      from k a join k b on a.m = b.m and a.side = b.side and a.part = b.part and (b.doc_id, b.no) < (a.doc_id, a.no)
      where abs(a.n - b.n) <= 1 and a.n >= 24),
q as (select *, coalesce(list_position(list_transform(list_zip(string_split(x, ''), string_split(y, '')), lambda z: z[1] is distinct from z[2]), true),
                         least(length(x), length(y)) + 1) as pos from p),
near as (select distinct doc_id, no from q
         where case length(x) - length(y) when 0 then substr(x, pos + 1) = substr(y, pos + 1)
                 when 1 then substr(x, pos + 1) = substr(y, pos) else substr(x, pos) = substr(y, pos + 1) end),
gone as (select doc_id, no, 0 as near from o where nth > 1 union all select doc_id, no, 1 from near),
per as (select doc_id, count(*) as c, sum(near) as near, string_agg(cast(no as varchar), ',' order by no) as nos from gone group by doc_id)
select d.doc_id, cast((select count(*) from l where l.doc_id = d.doc_id) as bigint) as n_lines, cast(coalesce(c, 0) as bigint) as n_removed,
       cast(coalesce(near, 0) as bigint) as n_near, coalesce(nos, '') as removed_lines
from documents d left join per using (doc_id)
"""

# ---- op5 ----


def _escaped_length(t: str, control: list[str]) -> str:
    extra = "".join(f" + (length({t}) - length(replace({t}, '{c}', ''))) // {len(c)}" for c in ["\\", *control])
    return f"(length({t}){extra})"


OP5 = f"""
with c as (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations
           union all values (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok'))
select conv_id, cast(count(*) as bigint) as n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t)) as turns_sha256,
       cast(coalesce(sum(length(t)) filter (r = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (r = 'assistant'), '')) as loss_sha256,
       cast(sum(4 + {_escaped_length('r', ['### ', '</turn>', ': '])} + 2 + {_escaped_length('t', ['### ', '</turn>'])} + 8) as bigint) as formatted_chars
from c group by conv_id
"""

# ---- op6: every window of an item's length looked up ----

OP6 = f"""
with d as (select doc_id, {_words('text', _ALNUM)} as ws from documents),
b as (select distinct cast(item_id as varchar) as item, {_words('text', _ALNUM)} as ws from benchmark),
bw as (select distinct item, least(len(ws), 13) as size, unnest(list_transform(range(1, len(ws) - least(len(ws), 13) + 2),
         lambda i: array_to_string(ws[i:i + least(len(ws), 13) - 1], ' '))) as win from b where len(ws) > 0),
sizes as (select distinct size from bw),
dw as (select doc_id, size, unnest(range(1, len(ws) - size + 2)) as pos,
              unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) as win
       from d cross join sizes where len(ws) >= size),
hits as (select doc_id, pos, dw.size, item from dw join bw on dw.win = bw.win and dw.size = bw.size),
covered as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(pos, pos + size)) as word from hits) group by doc_id),
found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join covered using (doc_id) left join found using (doc_id)
"""

# ---- op9: measures, then expectation-maximisation as a recursive query over pattern counts ----

_STOP = ", ".join(f"'{x}'" for x in qr.FUNCTION_WORDS)
_V = [f"v{j}" for j in range(len(qr.RULES))]
_VOTES = [
    ("false", "word_chars < 2 * n_words or word_chars > 13 * n_words or n_words = 0"),
    ("false", "5 * n_symbols > n_words"),
    ("false", "10 * n_dup_lines > 4 * n_lines"),
    ("false", "10 * n_repeat_words > 3 * n_words"),
    ("false", "10 * n_upper > 3 * word_chars"),
    ("false", "10 * n_bang > n_words"),
    ("n_function >= 3 and 2 * n_ended >= n_lines", "n_function = 0"),
    ("50 * n_symbols <= n_words and 50 * n_bang <= n_words and 10 * n_upper <= word_chars and n_words > 0", "false"),
]
_Z = "ln(good / (1 - good))" + "".join(f" + v{j} * ln(a{j} / (1 - a{j}))" for j in range(len(_V)))
_LOW_A, _HIGH_A = qr.ACCURACY
OP9 = f"""
with recursive t as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, regexp_extract_all(t, '{_SPACED}') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from t),
tri as (select doc_id, i, array_to_string(ws[i:i + 2], ' ') as g
        from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)),
again as (select doc_id, count(distinct word) as c from (
            select doc_id, unnest([i, i + 1, i + 2]) as word
            from (select doc_id, i, count(*) over (partition by doc_id, g) as n from tri) where n > 1) group by doc_id),
f as (select w.doc_id, cast(len(ws) as bigint) as n_words,
             cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) as word_chars,
             cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, cast(coalesce(c, 0) as bigint) as n_repeat_words,
             len(ls) as n_lines, len(list_filter(ls, lambda x: regexp_matches(x, '[.!?:…»”"'')][ \\t\\r]*$'))) as n_ended,
             length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) as n_upper, length(t) - length(replace(t, '!', '')) as n_bang,
             len(list_filter([{_STOP}], lambda s: list_contains(list_transform(ws, lambda x: lower(x)), s))) as n_function
      from w left join again using (doc_id)),
v as (select *, {', '.join(f"case when {bad} then -1 when {good} then 1 else 0 end as v{j}" for j, (good, bad) in enumerate(_VOTES))} from f),
pat as (select {', '.join(_V)}, cast(count(*) as double) as n from v group by all),
em(i, good, {', '.join(f'a{j}' for j in range(len(_V)))}) as (
  select 0, cast(0.8 as double), {', '.join('cast(0.8 as double)' for _ in _V)}
  union all
  select i + 1, least(0.99e0, greatest(0.5e0, sum(n * p) / sum(n))),
         {', '.join(f"least({_HIGH_A}e0, greatest({_LOW_A}e0, (sum(case when v{j} > 0 then n * p when v{j} < 0 then n * (1 - p) else 0 end) + 1.6e0) / (sum(case when v{j} <> 0 then n else 0 end) + 2.0e0)))" for j in range(len(_V)))}
  from (select em.*, pat.*, 1 / (1 + exp(-({_Z}))) as p from em cross join pat where i < {qr.EM_ROUNDS})
  group by i
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {qr.MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < {qr.MIN_WORDS} or 100 * n_repeat_words > 50 * n_words) and 1 / (1 + exp(-({_Z}))) >= {qr.KEEP_AT} as kept
from v cross join (select * from em where i = {qr.EM_ROUNDS})
"""

# ---- op11: payloads grouped whole; base32 five bits at a time ----

OP11 = """
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, h, cast(octet_length(encode(h)) as bigint) as payload_bytes, sha1(h) as x from p),
o as (select *, row_number() over (partition by h order by page_id nulls last) as nth,
             first_value(page_id) over (partition by h order by page_id nulls last) as first_id from q)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         cast(1 + ((('0x' || substr(x, 1 + 10 * cast(i // 8 as integer), 10))::bigint >> cast(35 - 5 * (i % 8) as integer)) & 31) as integer), 1)), '') as payload_digest,
       case when nth = 1 then 'response' else 'revisit' end as record_type, case when nth > 1 then first_id end as refers_to
from o
"""
