"""DuckDB SQL for the results of the training-data queries."""

from __future__ import annotations

from tracelode.llm.common import LOWER, UPPER
from tracelode.llm.secret_scan import KINDS, ORDER, PLACEHOLDER, WIDE_OWNERS, WIDE_REPOS
from tracelode.llm.sharding import SLACK, SLOTS

_SPANS = " union all ".join(
    f"""select rid, doc_id, source, lang, {ORDER.index(kind)} as r, '{kind}' as kind, m.at as start, m.at + length(m.w) as stop,
  {"regexp_extract(m.w, $p$" + pattern + "$p$, " + str(group) + ")" if group else "m.w"} as v
from (select d.*, unnest(list_reduce(list_prepend({{'at': 0, 'w': '', 'all': []::struct("at" bigint, w varchar)[]}},
  list_transform(regexp_extract_all(text, $p${pattern}$p$), lambda x: {{'at': 0, 'w': x, 'all': []::struct("at" bigint, w varchar)[]}})),
  lambda a, x: {{'at': a.at + instr(text[a.at + 1:], x.w) - 1 + length(x.w), 'w': '',
    'all': list_append(a.all, {{'at': a.at + instr(text[a.at + 1:], x.w) - 1, 'w': x.w}})}}).all) as m from d)
where length(v) >= {least}"""
    for kind, (pattern, group, least) in KINDS.items()
)

SECRET_SCAN = f"""with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text, source, lang from documents),
base as ({_SPANS}),
stats as (select v, count(distinct coalesce(source, '')) as n_owners,
  count(distinct [coalesce(source, ''), concat_ws('/', source, lang)]) as n_repos from base group by v),
judged as (select b.*, case when n_owners >= {WIDE_OWNERS} or (n_owners > 1 and n_repos >= {WIDE_REPOS}) then 'example'
  when n_owners = 1 and n_repos < {WIDE_REPOS} and length(v) >= 12 and len(list_distinct(string_split(v, ''))) >= 8 and regexp_matches(v, '[0-9]')
    and not regexp_matches(v, '{PLACEHOLDER}') then 'live' end as verdict from base b join stats using (v)),
every as (select rid, r, kind, start, stop from judged union
  select rid, case verdict when 'live' then {ORDER.index("live")} else {ORDER.index("example")} end, verdict, stop - length(v), stop
  from judged where verdict is not null),
per as (select rid, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
  count(*) filter (kind = 'hex') as n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' order by start, r) filter (r < {len(KINDS)}) as base,
  string_agg(kind || ':' || start || ':' || stop, ',' order by start, r, stop) as spans from every group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join per using (rid)"""

TOPK_SEARCH = """with v as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select q.vec_id as query_id, c.vec_id,
  coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0)::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 10"""

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATE = f"""with
d as (select row_number() over () as rid, doc_id,
  list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_BREAK}'), lambda w: w <> '') as w from documents),
b as (select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_BREAK}'), lambda w: w <> '') as w
  from benchmark where item_id is not null),
bw as (select distinct item_id, least(len(w), 13) as len, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as t
  from (select *, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i from b where len(w) > 0)),
dw as (select rid, i, l.len, array_to_string(w[i:i + l.len - 1], ' ') as t
  from (select distinct len from bw) l, (select rid, w, unnest(range(1, len(w) + 1)) as i from d) where i + l.len - 1 <= len(w)),
hits as (select distinct rid, i, dw.len, item_id from dw join bw on dw.len = bw.len and dw.t = bw.t),
n as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + len)) as p from hits) group by rid),
items as (select rid, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items
  from (select distinct rid, item_id from hits) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join n using (rid) left join items using (rid)"""

# The checksum by its table of 256 remainders; the slot map by moving one slot after another, or exchanging two.
# Null ids and ids heavier than a mean slot, which the operator spreads, are not stated here.
_GAP = "list_max(totals) - list_min(totals)"
_HEAVY = "list_position(totals, list_max(totals)) - 1"
_FITS = f"""list_filter(range({SLOTS}), lambda s: shard_of[s + 1] = {_HEAVY} and bytes_of[s + 1] > 0 and bytes_of[s + 1] < {_GAP})"""
_BEST = f"list_min(list_transform({_FITS}, lambda s: [abs(2 * bytes_of[s + 1] - ({_GAP})), s]))[2]"
_APART = "(bytes_of[s + 1] - bytes_of[l + 1])"
_PAIR = f"""list_min(flatten(list_transform(list_filter(range({SLOTS}), lambda s: shard_of[s + 1] = heavy and bytes_of[s + 1] > 0), lambda s:
  list_transform(list_filter(range({SLOTS}), lambda l: shard_of[l + 1] = light and {_APART} > 0 and {_APART} < gap),
    lambda l: [abs(2 * {_APART} - gap), s, l]))))"""
SHARDS = f"""with recursive
table_ as (select list(list_reduce(list_prepend(n, range(8)), lambda c, j: xor(c >> 1, (c & 1) * 3988292384)) order by n) as t
  from range(256) r(n)),
d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
hexed as (select rid, doc_id, text, hex(encode(text)) as h, t from d cross join table_),
sized as (select rid, doc_id, (length(h) // 2 + 1)::bigint as size,
  xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i::int + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::bigint as text_crc32,
  (('0x' || left(md5(coalesce(doc_id::varchar, '')), 8))::bigint % {SLOTS})::int as virtual_slot from hexed),
per_slot as (select s as virtual_slot, coalesce(sum(size), 0)::bigint as b, count(size) as n from range({SLOTS}) r(s)
  left join sized on virtual_slot = s group by s),
start_ as (select list(b order by virtual_slot) as bytes_of, list((virtual_slot % 16)::bigint order by virtual_slot) as shard_of from per_slot),
moves as (select 0 as step, bytes_of, shard_of, list_transform(range(16), lambda k: list_sum(list_transform(range({SLOTS}), lambda s:
    case when shard_of[s + 1] = k then bytes_of[s + 1] else 0 end))::bigint) as totals, null::bigint as moved, null::bigint as away from start_
  union all
  select step + 1, bytes_of, list_transform(shard_of, lambda x, i: case when i - 1 = away then light when i - 1 = back then heavy else x end),
    list_transform(totals, lambda x, i: case when i - 1 = heavy then x - net when i - 1 = light then x + net else x end), away, light
  from (select *, bytes_of[away + 1] - coalesce(bytes_of[back + 1], 0) as net
    from (select * exclude (moved, away), coalesce(best, pair[2]) as away, pair[3] as back
      from (select *, case when best is null then {_PAIR} end as pair
        from (select *, {_HEAVY} as heavy, list_position(totals, list_min(totals)) - 1 as light, {_GAP} as gap, {_BEST} as best from moves
          where step < {SLOTS} and greatest(list_max(totals) - list_sum(totals) / 16, list_sum(totals) / 16 - list_min(totals)) > {SLACK}::double * list_sum(totals) / 16))))
  where away is not null),
last_ as (select shard_of, step from moves order by step desc limit 1),
placed as (select virtual_slot, shard_of[virtual_slot + 1] as shard, case when step > 0 then 2 else 1 end as map_version, coalesce(sum(n) over (
  partition by shard_of[virtual_slot + 1] order by virtual_slot rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from per_slot cross join last_)
select doc_id, size, text_crc32, 'bytes' as law, shard::int as shard,
  (before + row_number() over (partition by virtual_slot order by doc_id nulls first, text_crc32, size) - 1)::bigint as slot,
  null::int as grown_shard, virtual_slot, map_version
from sized join placed using (virtual_slot)"""

# Vector codes by comparing every part with every entry, one round after another.
_PARTS, _ENTRIES, _ROUNDS = 4, 256, 4


def _assigned(k: int) -> str:
    apart = "list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i])))::bigint"
    return f"""near{k} as materialized (select rid, part, min([coalesce(d, 0), entry]) as best
  from (select rid, p.part, entry, {apart} as d from p join c{k} c on p.part = c.part) group by rid, part)"""


def _moved(k: int) -> str:
    return f"""c{k + 1} as materialized (select c.part, c.entry, coalesce(m.x, c.x) as x from c{k} c left join
  (select part, entry, list((s - ((s % n) + n) % n) // n order by i)::bigint[] as x
   from (select p.part, best[2] as entry, i, sum(x[i])::hugeint as s, count(*) as n
     from p join near{k} using (rid, part), range(1, 1 + (select max(len(x)) from p)) r(i) group by all) group by part, entry) m
  on m.part = c.part and m.entry = c.entry)"""


VECTOR_CODES = f"""with v as (select row_number() over (order by vec_id nulls last) as rid, vec_id, label,
    list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
size_ as (select (max(len(v)) + {_PARTS - 1}) // {_PARTS} as m from v),
p as materialized (select rid, k as part, list_resize(v, {_PARTS} * m, 0)[k * m + 1:(k + 1) * m] as x from v, size_, range({_PARTS}) r(k)),
c0 as materialized (select part, rid - 1 as entry, x from p where rid <= {_ENTRIES}),
{", ".join(f"{_assigned(k)}, {_moved(k)}" for k in range(_ROUNDS))}, {_assigned(_ROUNDS)},
coded as (select rid, string_agg(lpad(to_hex(best[2]), 2, '0'), '' order by part) as code, sum(best[1])::bigint as error from near{_ROUNDS} group by rid),
books as (select sha256(string_agg(y::varchar, ',' order by part, entry, i)) as codebooks_sha256
  from (select part, entry, unnest(x) as y, unnest(range(1, len(x) + 1)) as i from c{_ROUNDS})),
sums as (select label, sum(error)::bigint as label_error from coded join v using (rid) group by label)
select vec_id, lower(code) as code, error, label_error, codebooks_sha256
from v join coded using (rid) join sums on sums.label is not distinct from v.label cross join books"""

# Checksums of the distinct words by the table of 256 remainders.
_WORDS = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_BREAK}'), lambda w: w <> '')"
IMPORTANCE = f"""with
table_ as (select list(list_reduce(list_prepend(n, range(8)), lambda c, j: xor(c >> 1, (c & 1) * 3988292384)) order by n) as t
  from range(256) r(n)),
d as materialized (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
b as materialized (select {_WORDS} as w from benchmark),
dw as materialized (select rid, unnest(w) as word from d), bw as materialized (select unnest(w) as word from b),
hexed as (select word, hex(encode(word)) as h, t from (select word from dw union select word from bw) cross join table_),
hashed as materialized (select word, xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i::int + 1, 2))::bigint)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)::bigint % 10000 as bucket from hexed),
s as (select bucket, count(*) as s from dw join hashed using (word) group by bucket),
t as (select bucket, count(*) as t from bw join hashed using (word) group by bucket),
gain as (select bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * ((select count(*) from dw)::double + 10000)
    / ((s::double + 1) * ((select count(*) from bw)::double + 10000))))::bigint as gain from s left join t using (bucket)),
weighed as (select rid, sum(gain)::bigint as weight from dw join hashed using (word) join gain using (bucket) group by rid),
scored as (select doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::varchar, '')), 8))::bigint + 0.5::double)
    / 4294967296::double))))::bigint as score from d left join weighed using (rid)),
placed as (select *, case when n_features >= 20 then row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last, n_features) end as place from scored)
select doc_id, n_features, weight, score, case when place <= 10 * (select count(*) from scored where n_features >= 20) // 100 then place end as rank from placed"""

# All pairs of distinct sets that share a shingle, counted.
JACCARD = f"""with recursive
d as materialized (select row_number() over () as rid, doc_id,
  list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
sets as materialized (select rid, doc_id, list_sort(list_distinct(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as x from d),
one as materialized (select row_number() over () as k, x, min(doc_id) as least from sets where len(x) > 0 group by x),
each_ as materialized (select k, len(x) as n, unnest(x) as s from one),
links as materialized (select a.k as u, b.k as v from each_ a join each_ b on a.s = b.s and a.k <> b.k
  and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) group by a.k, b.k, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach as (select k as u, k as v from one union select r.u, l.v from reach r join links l on r.v = l.u),
named as (select u, min(least) as component_id from reach join one on v = k group by u)
select doc_id, len(sets.x)::bigint as n_shingles, case when len(sets.x) = 0 then doc_id else component_id end as component_id
from sets left join one on sets.x = one.x left join named on u = k"""
