"""DuckDB SQL for SimHash components: 64-bit hashes in 128-bit arithmetic, pairs and reachability.

The hash is the public XXH64 with seed 42. Pairs are all against all, which only small tables allow.
"""

from __future__ import annotations

from tracelode.llm.common import LOWER, UPPER

SEED = 42
# The multipliers of XXH64.
P1 = 11400714785074694791
P2 = 14029467366897019727
P3 = 1609587929392839161
P4 = 9650029242287828579
P5 = 2870177450012600261

WRAP = f"{2**64}::uhugeint"


def word(value: int) -> str:
    return f"{value % 2**64}::uhugeint"


def mul(a: str, b: int) -> str:
    return f"(({a}) * {b}::uhugeint % {WRAP})"


def add(*terms: str) -> str:
    return f"(({' + '.join(f'({t})' for t in terms)}) % {WRAP})"


def rotl(x: str, n: int) -> str:
    return f"((({x}) << {n}) % {WRAP} | (({x}) >> {64 - n}))"


def lane(start: str, n: int) -> str:
    """`n` bytes of the hex text x from byte `start`, the lowest first."""
    parts = " || ".join(f"substr(x, 2 * ({start} + {n - 1 - i})::int + 1, 2)" for i in range(n))
    return f"('0x' || {parts})::ubigint::uhugeint"


def mixed(acc: str, value: str) -> str:
    return mul(rotl(add(acc, mul(value, P2)), 31), P1)


def merged(h: str, acc: str) -> str:
    """`h` with an accumulator whose own mix is in column `acc`."""
    return add(mul(f"xor({h}, {acc})", P1), P4)


_BITS = ", ".join(f"sum((h >> {b}) & 1) as b{b}" for b in range(64))
_PRINT = " + ".join(f"(case when 2 * b{b} > n then {2**b} else 0 end)::uhugeint" for b in range(64))
_ZERO = word(0)

SIMHASH = f"""with recursive
d as (select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
runs as (select rid, case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end as r from d),
each_ as (select rid, unnest(r) as s from runs),
texts_ as (select s, hex(encode(s)) as x, length(hex(encode(s))) // 2 as n from (select distinct s from each_)),
acc as (select s, x, n, 0::bigint as k, {word(SEED + P1 + P2)} as a, {word(SEED + P2)} as b, {word(SEED)} as c, {word(SEED - P1)} as d from texts_ where n >= 32
  union all select s, x, n, k + 1, {mixed('a', lane('32 * k', 8))}, {mixed('b', lane('32 * k + 8', 8))}, {mixed('c', lane('32 * k + 16', 8))}, {mixed('d', lane('32 * k + 24', 8))} from acc where k < n // 32),
long_ as (select s, x, n, a, b, c, d, {add(rotl('a', 1), rotl('b', 7), rotl('c', 12), rotl('d', 18))} as h from acc where k = n // 32),
m1 as (select *, {mixed(_ZERO, 'a')} as ra, {mixed(_ZERO, 'b')} as rb, {mixed(_ZERO, 'c')} as rc, {mixed(_ZERO, 'd')} as rd from long_),
m2 as (select s, x, n, {merged('h', 'ra')} as h, rb, rc, rd from m1),
m3 as (select s, x, n, {merged('h', 'rb')} as h, rc, rd from m2),
m4 as (select s, x, n, {merged('h', 'rc')} as h, rd from m3),
m5 as (select s, x, n, {merged('h', 'rd')} as h from m4),
first_ as (select s, x, n, n // 32 * 32 as pos, {add('h', 'n::uhugeint')} as h from m5
  union all select s, x, n, 0, {add(word(SEED + P5), 'n::uhugeint')} from texts_ where n < 32),
tail as (select s, x, n, pos, h from first_
  union all select s, x, n, pos + case when n - pos >= 8 then 8 when n - pos >= 4 then 4 else 1 end,
    case when n - pos >= 8 then {add(mul(rotl(f"xor(h, {mixed(_ZERO, lane('pos', 8))})", 27), P1), P4)}
      when n - pos >= 4 then {add(mul(rotl(f"xor(h, {mul(lane('pos', 4), P1)})", 23), P2), P3)}
      else {mul(rotl(f"xor(h, {mul(lane('pos', 1), P5)})", 11), P1)} end from tail where pos < n),
v1 as (select s, xor(h, h >> 33) as h from tail where pos = n),
v2 as (select s, {mul('h', P2)} as h from v1), v3 as (select s, {mul('xor(h, h >> 29)', P3)} as h from v2),
hashed as (select s, xor(h, h >> 32)::ubigint as h from v3),
bits as (select rid, count(*) as n, {_BITS} from each_ join hashed using (s) group by rid),
prints as (select rid, ({_PRINT})::ubigint as fp from bits),
docs as (select doc_id, coalesce(fp, 0::ubigint) as fp from d left join prints using (rid)),
nodes as (select fp, min(doc_id) as least from docs group by fp),
links as (select p.fp as u, q.fp as v from nodes p join nodes q on bit_count(xor(p.fp, q.fp)::bit) <= 3),
reach as (select fp as u, fp as v from nodes union select r.u, l.v from reach r join links l on r.v = l.u),
named as (select u, min(least) as component_id from reach join nodes on v = fp group by u)
select doc_id, lpad(lower(to_hex(fp)), 16, '0') as fingerprint, component_id from docs join named on fp = u"""
