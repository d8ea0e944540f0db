"""SQL of the queries that SQL can express, for the engine that checks results."""

from __future__ import annotations

#: Cheapest edits by rows: for every row and state the least (cost, audit), at most two insertions before each edit.
CONVERSATIONS = r"""
with recursive checksum as materialized (
    select list_transform(range(256), lambda b: list_reduce(
        list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end
    )) as places
), named as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint) as name
    from conversations
), drawn as (
    select conv_id, turn, role, text, xor(4294967295, list_reduce(
        list_concat([4294967295], name), lambda c, b: xor(c >> 8, places[(xor(c, b) & 255) + 1])
    )) % 20 as kind
    from named, checksum
), copied as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(case kind when 0 then [] when 3 then [0, 1] else [0] end) as copy
    from drawn
), ordered as (
    select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as i
    from copied
), judged as (
    select *, case
            when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
            when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
            when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault,
        left(role, 1) as initial,
        lag(left(role, 1)) over (partition by conv_id order by i) as previous
    from ordered
), chains as (
    select * from (values (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
        (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')) t(state, became, cost, audit)
), moves as (
    select * from (values
        (0, 'D', null, 0, 3), (1, 'D', null, 1, 3), (2, 'D', null, 2, 3), (3, 'D', null, 3, 3),
        (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0),
        (0, 'R', null, 2, 2), (1, 'R', null, 2, 2), (2, 'R', null, 3, 2), (3, 'R', null, 2, 2)) t(state, edit, initial, became, cost)
), search as (
    select conv_id, 0::bigint as i, 0 as state, 0 as cost, '' as audit from (select distinct conv_id from conversations)
    union all
    select conv_id, i, state, best.cost, best.audit from (
        select s.conv_id, r.i, m.became as state,
            min({'cost': s.cost + c.cost + m.cost + case when m.edit <> 'D' and r.fault = 'truncated' then 1 else 0 end, 'audit': s.audit || c.audit || m.edit}) as best
        from search s
        join judged r on r.conv_id is not distinct from s.conv_id and r.i = s.i + 1
        join chains c on c.state = s.state
        join moves m on m.state = c.became and (m.initial is null or m.initial = r.initial) and (m.edit = 'D' or r.fault not in ('blank', 'duplicate'))
        group by s.conv_id, r.i, m.became
    )
), answered as (
    select conv_id, best.cost as cost, best.audit as audit from (
        select s.conv_id, min({'cost': s.cost + c.cost, 'audit': s.audit || c.audit}) as best
        from search s
        join (select conv_id, max(i) as i from search group by conv_id) n on n.conv_id is not distinct from s.conv_id and n.i = s.i
        join chains c on c.state = s.state and c.became in (0, 3)
        group by s.conv_id
    )
), steps as (
    select conv_id, p, substr(audit, p, 1) as edit, length(replace(left(audit, p), 'I', '')) as i, length(replace(left(audit, p), 'D', '')) as o
    from (select conv_id, audit, unnest(range(1, length(audit) + 1)) as p from answered)
), turns as (
    select s.conv_id, s.p, s.o, s.edit, r.role, r.text, max(case when s.o = 1 and s.edit = 'K' and r.initial = 's' then 1 else 0 end) over (partition by s.conv_id) as led
    from steps s left join judged r on s.edit <> 'I' and r.conv_id is not distinct from s.conv_id and r.i = s.i
    where s.edit <> 'D'
), repaired as (
    select conv_id, string_agg(
        case when edit = 'K' then role when (o - led) % 2 = 1 then 'user' else 'assistant' end || ':' || case when edit = 'I' then '' else text end, chr(10) order by p
    ) as lines
    from turns group by conv_id
), counted as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (previous is not null and previous || initial not in ('su', 'ua', 'au')) as illegal
    from judged group by conv_id
)
select a.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
    coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, a.cost::bigint as cost, a.audit, sha256(coalesce(lines, '')) as repaired_sha256
from answered a
left join counted c on c.conv_id is not distinct from a.conv_id
left join repaired r on r.conv_id is not distinct from a.conv_id
"""

#: Every window as text; a word goes if the last repeated window up to it begins less than twenty words before.
SUBSTRINGS = r"""
with texts as (
    select row_number() over () as r, doc_id, coalesce(doc_id, -9223372036854775808) as id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents
), places as (
    select r, id, i, md5(array_to_string(words[i : i + 19], ' ')) as edge
    from (select r, id, words, unnest(range(1, len(words) - 18)) as i from texts)
), firsts as (
    select edge, min({'id': id, 'i': i}) as place from places group by edge having count(*) > 1
), repeated as (
    select r, i from places join firsts using (edge) where (id, i) > (place.id, place.i)
), single as (
    select r, i, words[i] as word from (select r, words, unnest(range(1, len(words) + 1)) as i from texts)
), judged as (
    select s.r, s.i, s.word, coalesce(s.i - max(p.i) over (partition by s.r order by s.i) < 20, false) as gone
    from single s left join repeated p using (r, i)
), cut as (
    select r, count(*) as n_words, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept from judged group by r
)
select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join cut using (r)
"""
