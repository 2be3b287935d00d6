"""The SQL of the operators that SQL can express, for the tables' views."""

from __future__ import annotations

from waterline.llm.mixing import DIGITS, SEED

_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

MIXING = f"""
with docs as (
  select doc_id, source, {_SIZE}::bigint as size,
         substr(md5(coalesce(doc_id::varchar, '')), 1, {DIGITS}) as hash
  from documents
),
sources as (
  select *, 2.0::double * source_size as most,
         [3.0, 1.0, 2.0][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::double as weight
  from (select source, sum(size)::bigint as source_size from docs group by source)
),
levels as (
  select *, (1.5::double * sum(source_size) over ()::double - coalesce(sum(most) over earlier, 0.0))
            / (sum(weight) over () - coalesce(sum(weight) over earlier, 0.0)) as per_weight
  from sources
  window earlier as (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding)
),
targets as (
  select source, source_size,
         case when most > per_weight * weight
              then (max(case when most > per_weight * weight then per_weight end) over ()) * weight
              else most end as target,
         ('0x' || substr(md5('{SEED}' || coalesce(source, chr(0))), 1, 8))::bigint::double / 4294967296.0::double as u
  from levels
),
ranked as (
  select *, row_number() over (partition by source order by size, hash, doc_id) as place from docs
),
rated as (
  select d.*, t.source_size, t.target, t.u,
         case when t.source_size > 0 then t.target / t.source_size::double else 0.0 end as rate
  from ranked d join targets t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       ((floor(place * rate + u) - floor((place - 1) * rate + u))::bigint * size)::bigint as taken
from rated
"""

SEARCH = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(1024::double * x::double)) as v,
         row_number() over () as own
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, q.own, c.vec_id, list_dot_product(q.v::double[], c.v::double[])::bigint as score
  from vectors q join vectors c on q.own <> c.own and len(q.v) = len(c.v)
  where q.vec_id % 100 = 0
),
ranked as (
  select *, row_number() over (partition by own order by score desc, vec_id) as rank from scored
)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 10
"""

NEGATIVES = """
with vectors as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256::double * x::double)) as v, row_number() over () as own
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select a.own, a.id as anchor_id, c.id, a.label = c.label as same,
         list_dot_product(a.v::double[], c.v::double[])::bigint as score
  from vectors a join vectors c on a.own <> c.own and len(a.v) = len(c.v)
  where a.id % 50 = 0
),
positives as (
  select own, anchor_id, id as positive_id, score as positive_score, row_number() over (partition by own order by score desc, id) as slot
  from scored where same
),
negatives as (
  select p.*, s.id as negative_id, s.score as negative_score,
         row_number() over (partition by p.own, p.slot order by s.score desc, s.id) as rank
  from positives p join scored s on s.own = p.own and not s.same
  where p.slot <= 5 and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
)
select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score from negatives where rank <= 3
"""

REPAIR = r"""
with recursive src as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
  from conversations
),
summed as (
  select *, xor(4294967295::bigint, list_reduce(
           list_prepend(4294967295::bigint, list_transform(string_split(name, ''), lambda x: ascii(x)::bigint)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end))) % 20 as damage
  from src
),
damaged as (
  select conv_id, turn, case when damage = 4 then 'user' else role end as role,
         case damage when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from summed, unnest(case damage when 0 then [] when 3 then [0, 1] else [0] end) as copies(copy)
),
numbered as (
  select *, row_number() over (partition by conv_id, role, text order by turn nulls first) as seen from damaged
),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, seen) as pos,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) as last_char
  from numbered
),
faulty as (
  select *, left(role, 1) as initial,
         case when last_char = '' then 'blank' when seen > 1 then 'duplicate'
              when last_char not in ('.', '!', '?') then 'truncated' else '' end as fault,
         left(lag(role) over (partition by conv_id order by pos), 1) as before
  from placed
),
counted as (
  select conv_id, count(*) as n,
         coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (pos > 1 and before || initial not in ('su', 'ua', 'au')) as illegal
  from faulty group by conv_id
),
-- states: 0 nothing kept yet, 1 system row, 2 user row, 3 assistant row kept last
inserted(state, here, price, letters, lines) as (
  values (0, 0, 0, '', ''), (0, 2, 5, 'I', 'user:' || chr(10)), (0, 3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
         (1, 1, 0, '', ''), (1, 2, 5, 'I', 'user:' || chr(10)), (1, 3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
         (2, 2, 0, '', ''), (2, 3, 5, 'I', 'assistant:' || chr(10)), (2, 2, 10, 'II', 'assistant:' || chr(10) || 'user:' || chr(10)),
         (3, 3, 0, '', ''), (3, 2, 5, 'I', 'user:' || chr(10)), (3, 3, 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))
),
kept(here, initial, then_at) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
rewritten(here, role, then_at) as (values (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
moves as (
  select f.conv_id, f.pos, i.state, i.here as to_state, i.price + 2 as price, i.letters || 'D' as letters, i.lines
  from faulty f, inserted i
  union all
  select f.conv_id, f.pos, i.state, k.then_at, i.price + case when fault = 'truncated' then 5 else 0 end, i.letters || 'K',
         i.lines || f.role || ':' || f.text || chr(10)
  from faulty f, inserted i join kept k on k.here = i.here
  where k.initial = f.initial and fault not in ('blank', 'duplicate')
  union all
  select f.conv_id, f.pos, i.state, w.then_at, i.price + 1 + case when fault = 'truncated' then 5 else 0 end, i.letters || 'R',
         i.lines || w.role || ':' || f.text || chr(10)
  from faulty f, inserted i join rewritten w on w.here = i.here
  where fault not in ('blank', 'duplicate')
),
paths as (
  select conv_id, 0::bigint as pos, 0 as state, {'cost': 0, 'audit': '', 'lines': ''} as best from counted
  union all
  select p.conv_id, p.pos + 1, m.to_state,
         min({'cost': p.best.cost + m.price, 'audit': p.best.audit || m.letters, 'lines': p.best.lines || m.lines})
  from paths p join moves m on p.conv_id is not distinct from m.conv_id and m.pos = p.pos + 1 and m.state = p.state
  group by p.conv_id, p.pos, m.to_state
),
finished as (
  select p.conv_id, min({'cost': p.best.cost + i.price, 'audit': p.best.audit || i.letters, 'lines': p.best.lines || i.lines}) as best
  from paths p join counted c on p.conv_id is not distinct from c.conv_id and p.pos = c.n
  join inserted i on i.state = p.state and i.here in (0, 3)
  group by p.conv_id
)
select o.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
       coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, coalesce(f.best.cost, 0)::bigint as cost,
       coalesce(f.best.audit, '') as audit,
       sha256(coalesce(left(f.best.lines, greatest(length(f.best.lines) - 1, 0)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on o.conv_id is not distinct from c.conv_id
left join finished f on o.conv_id is not distinct from f.conv_id
"""

ORACLE = {"op11_negatives": NEGATIVES, "op13_conversations": REPAIR, "op3_mixing": MIXING, "op9_search": SEARCH}
