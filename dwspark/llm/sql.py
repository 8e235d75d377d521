"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_ESC = r"replace(replace({}, '\', '\\'), '<|', '<\|')"

OP9 = rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), ordered as (
  select *, lag(role) over (partition by conv_id order by turn nulls first, role, text) as before from rows
)
select conv_id,
  count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length({_ESC.format("text")})
      + case when before = role then length('<|im_join|>')
             else length('<|im_start|><|im_sep|><|im_end|>') + 1 + length({_ESC.format("role")}) end)::bigint as formatted_chars
from ordered group by conv_id
"""


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP3 = f"""
with d as (select doc_id, {_WORDS} as ws from documents),
b as (select item_id::varchar as item, {_WORDS} as ws from benchmark),
p as (
  select distinct item, least(13, len(ws)) as n, array_to_string(ws[i : i + least(13, len(ws)) - 1], ' ') as w
  from (select item, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) as i from b where len(ws) > 0)
), sizes as (select distinct n from p),
hits as (
  select doc_id, item, i, x.n from (
    select doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') as w
    from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, sizes where len(ws) >= n)
  ) x join p on p.w = x.w and p.n = x.n
), words as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(i, i + n)) as pos from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as all_items from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(all_items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""

OP5 = r"""
with docs as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
windows as (
  select doc_id, unnest(range(1, len(ls) - 1)) as i, ls from docs where len(ls) >= 3
), hashed as (
  select doc_id, i, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] as w from windows
), firsts as (
  select w, min(struct_pack(d := doc_id, p := i)) as first from hashed where regexp_matches(w, '[^\s]') group by w
), covered as (
  select distinct h.doc_id, unnest([h.i, h.i + 1, h.i + 2]) as i
  from hashed h join firsts f on h.w = f.w where struct_pack(d := h.doc_id, p := h.i) <> f.first
), lines as (
  select doc_id, unnest(range(1, len(ls) + 1)) as i, unnest(ls) as line from docs where text <> ''
)
select d.doc_id, coalesce(k.n_lines, 0)::bigint as n_lines, coalesce(k.n_removed, 0)::bigint as n_removed,
  case when coalesce(k.n_removed, 0) = 0 then d.text else coalesce(k.kept, '') end as text
from docs d left join (
  select l.doc_id, count(*) as n_lines, count(c.i) as n_removed, string_agg(line, chr(10) order by l.i) filter (where c.i is null) as kept
  from lines l left join covered c on c.doc_id = l.doc_id and c.i = l.i group by l.doc_id
) k on k.doc_id = d.doc_id
"""


OP8 = f"""
with recursive d as materialized (select doc_id, {_WORDS} as ws from documents),
s as materialized (
  select doc_id, list_sort(list_distinct(list_transform(range(1, greatest(1, len(ws) - 4) + 1), lambda i: array_to_string(ws[i : i + 4], ' ')))) as shingles
  from d where len(ws) > 0
),
classes as materialized (select shingles, min(doc_id) as class_id, count(*) as copies, len(shingles) as n from s group by shingles),
one as materialized (select class_id, n, copies, unnest(shingles) as g from classes),
links as materialized (
  select x.class_id as u, y.class_id as v, any_value(y.copies) as copies
  from one x join one y on x.g = y.g and x.class_id <> y.class_id
  group by x.class_id, y.class_id, x.n, y.n having 5 * count(*) >= 4 * (x.n + y.n - count(*))
),
reach(u, v) as (
  select u, v from links
  union select r.u, l.v from reach r join links l on l.u = r.v
),
groups as (select u, least(u, min(v)) as group_id from reach group by u),
counts as (select u, sum(copies) as links from links group by u)
select d.doc_id, coalesce(c.class_id, d.doc_id) as class_id, coalesce(c.copies - 1 + coalesce(k.links, 0), 0)::bigint as n_links,
  coalesce(g.group_id, c.class_id, d.doc_id) as group_id
from d left join s on s.doc_id = d.doc_id left join classes c on c.shingles = s.shingles
left join counts k on k.u = c.class_id left join groups g on g.u = c.class_id
"""


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP11 = f"""
with d as materialized (select doc_id, {_TERMS} as ts from documents),
sizes as (select count(*)::bigint as n_docs, sum(len(ts))::bigint as all_terms from d where len(ts) > 0),
tf as materialized (select doc_id, term, count(*) as tf, any_value(n) as n from (select doc_id, unnest(ts) as term, len(ts) as n from d) group by doc_id, term),
weights as (select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as w from tf, sizes group by term, n_docs),
items as (select item_id, unnest({_TERMS}) as term from benchmark),
scores as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // all_terms))))::bigint as score
  from items join tf using (term) join weights using (term), sizes group by item_id, doc_id
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scores where score > 0 qualify rank <= 20
"""

# One row at a time by dynamic programming that carries whole audits, state by state.
OP13 = r"""
with recursive crc as (
  select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as entry
), fates as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda ch: ascii(ch)::bigint),
      lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as fate
  from conversations, crc
), turns as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
    case fate when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(range(case when fate = 3 then 2 else 1 end)) as copy
  from fates where fate <> 0
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as k from turns
), faults as (
  select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
      when row_number() over (partition by conv_id, role, text order by k) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' end as fault,
    lead(role) over (partition by conv_id order by k) as after
  from numbered
), legal(state, role, next) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
added(state, into_state, cost, audit, said) as (
  select x, x, 0, '', []::varchar[] from range(4) t(x)
  union all values (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:']),
    (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])
), paths(conv_id, k, state, cost, audit, said) as (
  select distinct conv_id, 0::bigint, 0, 0::bigint, '', []::varchar[] from faults
  union all
  select conv_id, k, state, cost, audit, said from (
    select p.conv_id, f.k, o.state, p.cost + i.cost + o.cost as cost, p.audit || i.audit || o.letter as audit,
      p.said || i.said || case o.letter when 'D' then []::varchar[] when 'K' then [f.role || ':' || f.text] else [o.role || ':' || f.text] end as said
    from paths p join faults f on f.conv_id is not distinct from p.conv_id and f.k = p.k + 1
    join added i on i.state = p.state,
    lateral (
      select i.into_state as state, 4 as cost, 'D' as letter, '' as role
      union all select next, case when f.fault = 'truncated' then 3 else 0 end, 'K', '' from legal l where l.state = i.into_state and l.role = left(f.role, 1) and coalesce(f.fault, '') not in ('blank', 'duplicate')
      union all select next, case when f.fault = 'truncated' then 6 else 3 end, 'R', case l.role when 'u' then 'user' else 'assistant' end from legal l where l.state = i.into_state and l.role <> 's' and coalesce(f.fault, '') not in ('blank', 'duplicate')
    ) o
  ) qualify row_number() over (partition by conv_id, state order by cost, audit) = 1
), counts as (
  select conv_id, max(k) as n, count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where after is not null and left(role, 1) || left(after, 1) not in ('su', 'ua', 'au')) as illegal,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps
  from faults group by conv_id
), ends as (
  select p.conv_id, p.cost + i.cost as cost, p.audit || i.audit as audit, p.said || i.said as said
  from paths p join counts c on c.conv_id is not distinct from p.conv_id and c.n = p.k join added i on i.state = p.state and i.into_state in (0, 3)
  where p.state <> 0 or i.cost = 0
  qualify row_number() over (partition by p.conv_id order by p.cost + i.cost, p.audit || i.audit) = 1
)
select d.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, sha256(coalesce(array_to_string(said, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) d left join counts c on c.conv_id is not distinct from d.conv_id left join ends e on e.conv_id is not distinct from d.conv_id
"""


def llm_sql() -> dict[str, str]:
    return {"op3_decontamination": OP3, "op5_line_dedup": OP5, "op8_ngram_jaccard_join": OP8, "op9_chat_formatting": OP9, "op11_reversed_search": OP11, "op13_conversation_repair": OP13}
