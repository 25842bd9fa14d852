"""The operators' queries in SQL, where SQL can express them."""

from __future__ import annotations

#: Null html is empty; equal payloads refer to their largest page_id.
WARC = """
with rows as (select page_id, encode(coalesce(html, '')) as payload from pages),
digests as (
    select page_id, octet_length(payload) as n, sha1(payload) as hex,
           max(page_id) over (partition by sha1(payload)) as largest
    from rows
),
coded as (
    select *, list_aggregate(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + (('0x' || substr(hex, 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8)) & 31)::int, 1)
    ), 'string_agg', '') as base32
    from digests
)
select page_id, n::bigint as payload_bytes, base32 as payload_digest,
       case when page_id = largest then 'response' else 'revisit' end as record_type,
       case when page_id < largest then largest end as refers_to
from coded
"""

#: All pairs; the sorted passes find those links that exist.
VECTORS = """
with recursive usable as (
    select vec_id, label, embedding::double[] as v from embeddings
    where label is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
    select a.vec_id as a, b.vec_id as b from usable a join usable b
      on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.98
),
reached(vec_id, other) as (
    select vec_id, vec_id from embeddings
    union
    select reached.vec_id, links.b from reached join links on links.a = reached.other
),
components as (select vec_id, min(other) as component_id from reached group by vec_id),
counts as (select a as vec_id, count(*) as n from links group by a)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join components using (vec_id) left join counts using (vec_id)
"""

#: Every quotient of every claim is ranked; the query looks only at those that can decide.
MIXING = r"""
with words as (
    select doc_id, coalesce('0' || source, '1') as s,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
    from documents
),
sources as (
    select s, sum(size)::bigint as source_size, count(*) as n, row_number() over (order by s) - 1 as rank
    from words group by s
),
limited as (select *, [5.0, 2.0, 1.0][rank % 3 + 1]::double as weight, 3 * source_size as lim from sources),
shared as (
    select *,
           (sum(source_size) over ()
            - coalesce(sum(lim) over (order by lim / weight, rank rows between unbounded preceding and 1 preceding), 0)
           )::double as left_words,
           sum(weight) over (order by lim / weight, rank rows between current row and unbounded following) as left_weights
    from limited
),
stopped as (select *, lim * left_weights <= left_words * weight as stops from shared),
level as (
    select arg_min(left_words, (lim / weight, rank)) as w, arg_min(left_weights, (lim / weight, rank)) as x
    from stopped where not stops
),
targets as (
    select s, source_size, n, rank, case when stops then lim::double else weight * w / x end as target
    from stopped left join level on true
),
sizes as (
    select greatest(1, least(512, floor(min(target) filter (target > 0) / 400)))::bigint as block,
           sum(source_size)::bigint as words,
           greatest(1, ceil(sum(source_size) / 2000000), ceil(sum(n) / 100000))::bigint as shards
    from targets
),
seats as (select *, round_even(words / block, 0)::bigint as seats from sizes),
source_won as (
    select rank, count(*) as source_blocks from (
        select rank, row_number() over (order by target / (2 * k + 1) desc, rank, k) as place, seats
        from (select targets.*, seats, unnest(range(0, ceil(target * seats / words)::bigint + 40)) as k
              from targets, seats where target > 0)
    ) where place <= seats group by rank
),
members as (
    select s, doc_id, size, count(*) as copies,
           ('0x' || substr(md5('42:' || coalesce(doc_id::varchar, '') || ':' || size), 1, 15))::bigint as place
    from words group by s, doc_id, size
),
dealt as (select members.*, (place % shards)::int as shard from members, sizes),
held as (
    select rank, target, source_size, s, shard, sum(size * copies)::bigint as words, any_value(coalesce(source_blocks, 0)) as seats
    from dealt join targets using (s) left join source_won using (rank) group by all
),
shard_won as (
    select rank, shard, count(*) as won from (
        select rank, shard, row_number() over (partition by rank order by words / (2 * k + 1) desc, shard, k) as place, seats
        from (select *, unnest(range(0, ceil(words * seats / whole)::bigint + 40)) as k
              from (select *, sum(words) over (partition by rank) as whole from held) where words > 0 and seats > 0)
    ) where place <= seats group by rank, shard
),
blocked as (
    select held.*, greatest(1, round(held.words / block))::bigint as blocks, coalesce(won, 0) as won
    from held cross join sizes left join shard_won using (rank, shard)
),
streams as (
    select s, shard, source_size, target, blocks, least(won, 3 * blocks) as quota,
           (words // blocks)::bigint as size_of, words % blocks as longer,
           ('0x' || substr(md5('42:start:' || rank || ':' || shard), 1, 15))::bigint % blocks as shift
    from blocked
),
starts as (
    select *, coalesce(sum(size * copies) over (partition by s, shard order by place, doc_id, size
                                               rows between unbounded preceding and 1 preceding), 0)::bigint as start
    from dealt
),
placed as (
    select doc_id, size, start, unnest(range(0, copies)) as copy, streams.* exclude (s, shard)
    from starts join streams using (s, shard)
),
ends as (select *, unnest([start + copy * size, start + copy * size + size]) as pos, unnest([-1, 1]) as sign,
                row_number() over () as n from placed),
located as (
    select *, case when pos < longer * (size_of + 1) then pos // (size_of + 1)
                   else longer + (pos - longer * (size_of + 1)) // greatest(size_of, 1) end as b
    from ends
),
stepped as (
    select *, (b * quota + shift) // blocks as here, ((b + 1) * quota + shift) // blocks as next,
           (least(b, longer) * quota + shift) // blocks as in_longer, shift // blocks as first
    from located
),
before as (
    select *, (here - first) * size_of + in_longer - first + (next - here) * (pos - b * size_of - least(b, longer)) as taken
    from stepped
)
select doc_id, size, source_size, target, sum(sign * taken)::bigint as taken
from before group by n, doc_id, size, source_size, target
"""

#: CRC-32 of ASCII text, bit by bit.
CRC32 = """
list_reduce(
    list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::bigint),
    lambda crc, b: list_reduce(range(0, 8),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, xor(crc, b)),
    4294967295::bigint)
"""


def _crc32(text: str) -> str:
    return f"xor({CRC32.format(text).strip()}, 4294967295)"


#: Members of every prefix by a chained digest; subtrees by the prefixes that a node's smallest member goes through.
TRIE = r"""
with recursive turns as (
    select conv_id as conv, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as place
    from conversations where conv_id is not null
),
sizes as (
    select conv, count(*) as n, conv - conv % 5 as lender, CRC % 9 as h
    from (select *, conv::varchar as name from turns) group by conv, name
),
plan as (
    select sizes.conv, sizes.lender, sizes.h, least(sizes.h, coalesce(other.n, 0)) as taken
    from sizes left join sizes other on other.conv = sizes.lender
),
rebuilt as (
    select plan.conv, place, role, text from plan join turns on turns.conv = plan.lender where place < taken
    union all
    select plan.conv, place - h + taken, role, text from plan join turns on turns.conv = plan.conv where place >= h
),
paths(conv, depth, path, up, bytes) as (
    select conv, 0::bigint, '', null::varchar, 0::bigint from plan
    union all
    select paths.conv, depth + 1, md5(path || ':' || md5(length(role) || ':' || role || text)), path, octet_length(encode(text))::bigint
    from paths join rebuilt on rebuilt.conv = paths.conv and rebuilt.place = paths.depth
),
whole as (select conv, max(depth) as n from paths group by conv),
nodes as (
    select depth, path, any_value(up) as up, any_value(bytes) as bytes, min(conv) as conv, count(*) as n_convs,
           sha256(coalesce(string_agg(conv::varchar, ',' order by conv) filter (depth = n), '')) as ends
    from paths join whole using (conv) group by depth, path
),
children as (select depth - 1 as depth, up as path, count(*) as n from nodes where depth > 0 group by all),
told as (
    select nodes.*, coalesce(children.n, 0) as n_children, parent.conv as parent_conv
    from nodes left join children using (depth, path)
    left join nodes parent on parent.depth = nodes.depth - 1 and parent.path = nodes.up
),
sums as (
    select above.depth, above.path, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * told.bytes)::bigint as saved
    from told join paths above on above.conv = told.conv and above.depth <= told.depth
    group by above.depth, above.path
)
select conv as conv_id, depth, parent_conv as parent_conv_id, n_convs, n_children, n_leaves, saved as saved_tokens,
       ends as ends_sha256
from told join sums using (depth, path)
""".replace("CRC", _crc32("name"))

#: Each conversation by itself, from its last turn to its first: for every state of the grammar the least cost and edits.
REPAIR = r"""
with recursive named as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           coalesce(conv_id::varchar, ' ') as conv,
           coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
    from conversations
),
fault as (select *, CRC % 20 as f from named),
rows as (
    select conv, turn, case when f = 4 then 'user' else role end as role,
           case f when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from fault, range(0, case when f = 3 then 2 else 1 end) where f <> 0
),
placed as (
    select *, row_number() over w as place,
           lag(role[1]) over w || role[1] as pair,
           trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
    from rows
    window w as (partition by conv order by turn nulls first, role, md5(length(role) || ':' || role || text))
),
judged as (
    select *, case when body = '' then 'blank' when place > min(place) over (partition by conv, role, text) then 'duplicate'
                   when body[-1] not in ('.', '!', '?') then 'truncated' else '' end as fault
    from placed
),
counted as (
    select conv, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
           count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
           count(*) filter (fault = 'truncated') as truncated,
           count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
    from judged group by conv
),
ways(conv, place, q, s, u, a) as (
    select conv, n + 1, {'c': 0, 'e': ''}, {'c': 6, 'e': 'II'}, {'c': 3, 'e': 'I'}, {'c': 0, 'e': ''} from counted
    union all
    select conv, place,
           least(q0, {'c': least(u0, {'c': a0.c + 3, 'e': 'I' || a0.e}).c + 3, 'e': 'I' || least(u0, {'c': a0.c + 3, 'e': 'I' || a0.e}).e}),
           least(s0, {'c': least(u0, {'c': a0.c + 3, 'e': 'I' || a0.e}).c + 3, 'e': 'I' || least(u0, {'c': a0.c + 3, 'e': 'I' || a0.e}).e}),
           least(u0, {'c': a0.c + 3, 'e': 'I' || a0.e}),
           least(a0, {'c': u0.c + 3, 'e': 'I' || u0.e})
    from (
        select conv, here as place,
               list_min([d(q), r(u), k_u(q, u), k_s(q, s)]) as q0, list_min([d(s), r(u), k_u(s, u)]) as s0,
               list_min([d(u), r(a), k_a(u, a)]) as u0, list_min([d(a), r(u), k_u(a, u)]) as a0
        from (select ways.* exclude (place), judged.place as here, judged.role[1] as i, judged.fault from ways join judged
              on judged.conv = ways.conv and judged.place = ways.place - 1)
    )
),
best as (select conv, q.c as cost, q.e as audit from ways where place = 1),
letters as (
    select conv, audit, i, audit[i] as letter, i - length(replace(audit[1:i], 'I', '')) as inserted,
           length(replace(audit[1:i], 'D', '')) as put
    from best, range(1, length(audit) + 1) r(i)
),
first_role as (
    select conv, letters.letter = 'K' and judged.role[1] = 's' as system
    from letters join judged using (conv) where letters.put = 1 and letters.letter <> 'D' and judged.place = letters.i - letters.inserted
),
lines as (
    select letters.conv, i, case when letter = 'K' then judged.role
                     when (put - coalesce(system, false)::int) % 2 = 1 then 'user' else 'assistant' end
                || ':' || case when letter = 'I' then '' else judged.text end as line
    from letters left join first_role on first_role.conv = letters.conv
    left join judged on judged.conv = letters.conv and judged.place = i - inserted and letter <> 'I'
    where letter <> 'D'
),
digests as (select conv, sha256(string_agg(line, chr(10) order by i)) as repaired from lines group by conv)
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0)::bigint as cost,
       coalesce(audit, '') as audit, coalesce(repaired, sha256('')) as repaired_sha256
from (select distinct conv_id, conv from named)
left join counted using (conv) left join best using (conv) left join digests using (conv)
"""

_NONE = "{'c': 1000000, 'e': ''}"
for _name, _way in {
    "CRC": _crc32("name"),
    **{f"d({x})": f"{{'c': {x}.c + 4, 'e': 'D' || {x}.e}}" for x in "qsua"},
    **{
        f"r({x})": f"case when fault in ('', 'truncated') then {{'c': {x}.c + 3 + if(fault = '', 0, 3), 'e': 'R' || {x}.e}} "
        f"else {_NONE} end"
        for x in "ua"
    },
    **{
        f"k_{x}({y}, {x})": f"case when i = '{x}' and fault in ('', 'truncated') then "
        f"{{'c': {x}.c + if(fault = '', 0, 3), 'e': 'K' || {x}.e}} else {_NONE} end"
        for x, y in (("u", "q"), ("s", "q"), ("u", "s"), ("a", "u"), ("u", "a"))
    },
}.items():
    REPAIR = REPAIR.replace(_name, _way)

ORACLES: dict[str, str] = {
    "op2_warc": WARC, "op7_vectors": VECTORS, "op10_mixing": MIXING, "op11_trie": TRIE,
    "op12_repair": REPAIR,
}
