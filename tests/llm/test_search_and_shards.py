"""Top-k search and virtual slots."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tracelode.llm.sharding import SlotMap, shard_documents, slot_of
from tracelode.llm.topk_search import exact_topk


def brute(rows, k, every):
    out = []
    fit = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q, a in fit:
        if q % every:
            continue
        best = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in fit if i != q and len(b) == len(a))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(set(out))


def search(spark, rows, k=3, every=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(3)
    return sorted(map(tuple, exact_topk(df, F.col("vec_id") % every == 0, k, **options).collect()))


def test_search_equals_brute_force(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([-1.0, -0.5, 0.0, 0.25, 0.5]) for _ in range(6)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 340)]  # many equal vectors
    rows += [(1000, None), (1005, [0.1, None, 0.1, 0.1, 0.1, 0.1]), (1010, [float("nan")] * 6), (1015, [float("inf")] * 6)]
    rows += [(None, [0.5] * 6), (1020, [1.0, 2.0]), (1025, [3.0, 1.0]), (1030, [])]
    assert search(spark, rows) == brute(rows, 3, 5)
    assert search(spark, rows, query_block=16) == brute(rows, 3, 5)


def test_repeated_candidates_count_each(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.choice([-1.0, 0.5, 1.0]) for _ in range(4)]) for i in range(40)]
    rows += [(7, rows[7][1])] * 3 + [(11, rows[12][1])]
    want = []
    for q in range(0, 40, 5):
        scores = sorted((-round(1024 * 1024 * sum(x * y for x, y in zip(rows[q][1], v, strict=True))), i) for i, v in rows if i != q)
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:6], 1)]
    assert search(spark, rows, k=6) == sorted(want)


def test_phase_two_sends_back_few_entries(spark):
    """Only entries above the uniform threshold leave a task, and every answer has one."""
    from tracelode.llm import topk_search as t

    rng = np.random.default_rng(3)
    m = np.floor(1024 * rng.normal(size=(400, 8)) / 3).astype(np.int64)
    own = t.Queries(np.arange(4), m[:4, :4], np.sqrt((m[:4, 4:] ** 2).sum(1)))
    total = m[:4] @ m.T
    total[np.arange(4), np.arange(4)] = t.NONE
    cutoff = np.sort(total, axis=1)[:, -10]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(400)), pa.array(np.arange(400)), pa.array(np.full(400, 8, np.int32)), pa.array(np.zeros(400, np.int32)),
         pa.array(m[:, :4].tolist(), pa.list_(pa.int64())), pa.array(np.sqrt((m[:, 4:] ** 2).sum(1)))],
        names=["rid", "vec_id", "dim", "block", "part", "rest"],
    )
    sent = set()
    for out in t._above(iter([batch]), {(8, 0): own}, dict(enumerate(cutoff.tolist()))):
        sent |= set(zip(out.column(0).to_pylist(), out.column(2).to_pylist(), strict=True))
    local = m[:4, :4] @ m[:, :4].T
    want = {(q, v) for q, v in zip(*np.nonzero((total >= cutoff[:, None]) & (2 * local >= cutoff[:, None])), strict=True)}
    assert want <= sent and len(sent) < 4 * 400 / 5


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**18 + i), float(-(2**17)), 0.5]) for i in range(20)]
    assert search(spark, rows) == brute(rows, 3, 5)


def test_few_and_no_candidates(spark):
    assert search(spark, [(0, [1.0]), (1, [1.0])], k=10) == [(0, 1, 1, 1048576)]
    assert search(spark, [(0, [1.0])]) == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert exact_topk(empty, F.col("vec_id") % 5 == 0).count() == 0


def documents(spark, n=2000):
    rnd = random.Random(4)
    rows = [(i, "é" * rnd.randrange(200) if i % 3 else "same text", 7) for i in range(n)]
    rows += [(None, None, 1), (None, "", 1), (5, "again", 1), (5, "again", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, shard int")


def test_shards(spark):
    rows, df = documents(spark)
    got = shard_documents(df, 16).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    bytes_of = [sum(r.size for r in got if r.shard == s) for s in range(16)]
    assert max(bytes_of) - min(bytes_of) <= max(r.size for r in got)
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {r.law for r in got} == {"bytes"}
    assert len({(r.virtual_slot, r.shard) for r in got}) == len({r.virtual_slot for r in got})
    assert shard_documents(df.limit(0), 16).count() == 0


def test_growth_moves_few_slots(spark, tmp_path):
    loads = {s: 100 + s % 7 for s in range(4096)}
    first = SlotMap.first(16).rebalance(loads)
    grown = first.rebalance(loads, 17, slack=0.01)
    moved = [s for s in first.of if first.of[s] != grown.of[s]]
    assert {grown.of[s] for s in moved} == {16}
    assert abs(len(moved) - 4096 / 17) < 10
    totals = grown.totals(loads)
    assert max(totals) - min(totals) <= 0.03 * sum(totals) / 17
    assert (first.version, grown.version) == (2, 3)
    path = str(tmp_path / "map")
    first.save(spark, path)
    grown.save(spark, path)
    assert SlotMap.load(spark, path) == grown
    assert SlotMap.load(spark, path, 2) == first
    fewer = grown.rebalance(loads, 16)
    assert set(fewer.of.values()) == set(range(16))


def test_slots_too_large_to_move_change_places():
    loads = {0: 50, 1: 40, 2: 50, 3: 40}
    edited = SlotMap.first(2, slots=4).rebalance(loads)
    assert edited.totals(loads) == [90, 90]
    # Nothing narrows this gap; shards within the slack are left alone.
    assert SlotMap.first(2, slots=2).rebalance({0: 50, 1: 40}).totals({0: 50, 1: 40}) == [50, 40]
    near = {0: 2001, 1: 2000, 2: 2001, 3: 2000}
    assert SlotMap.first(2, slots=4).rebalance(near).of == SlotMap.first(2, slots=4).of


def test_a_shard_without_slots_is_loaded(spark, tmp_path):
    path = str(tmp_path / "map")
    SlotMap(5, 3, {0: 0, 1: 1}).save(spark, path)
    assert SlotMap.load(spark, path).shards == 5


def test_a_stored_map_is_edited_and_keeps_its_slots(spark, tmp_path):
    """The operator reads the latest version, moves what has to move, and stores the next."""
    rows, df = documents(spark)
    path = str(tmp_path / "maps")
    SlotMap.first(16).save(spark, path)
    one = {r.virtual_slot: r.shard for r in shard_documents(df, 16, maps=path).collect()}
    second = SlotMap.load(spark, path)
    assert second.version == 2 and all(second.of[s] == d for s, d in one.items())
    stay = {r.map_version for r in shard_documents(df, 16, maps=path).collect()}
    assert stay == {2} and SlotMap.load(spark, path) == second
    more = shard_documents(df, 17, maps=path).collect()
    third = SlotMap.load(spark, path)
    assert {r.map_version for r in more} == {3} and third.shards == 17
    moved = [s for s in second.of if second.of[s] != third.of[s]]
    kept = [s for s in one if s not in moved]
    assert len(moved) < 600 and all(third.of[s] == one[s] for s in kept)
    bytes_of = [sum(r.size for r in more if r.shard == s) for s in range(17)]
    assert max(bytes_of) - min(bytes_of) <= 2 * max(r.size for r in more)


def test_slots_do_not_depend_on_data(spark):
    df = spark.range(100).select(slot_of(F.col("id")).alias("s"))
    assert df.collect() == df.collect()
    assert all(0 <= r.s < 4096 for r in df.collect())


def test_null_and_repeated_ids_are_spread(spark):
    rnd = random.Random(8)
    rows = [(i, "x" * rnd.randrange(100)) for i in range(3000)]
    rows += [(None, f"{i} " + "x" * rnd.randrange(100)) for i in range(1500)]
    rows += [(7, f"{i} " + "x" * rnd.randrange(100)) for i in range(1500)]
    rows += [(None, None)] * 3500 + [(8, "same")] * 3500
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = shard_documents(df.repartition(3), 16, slots=256).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i is None, i or 0, len(t or "") + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    bytes_of = [sum(r.size for r in got if r.shard == s) for s in range(16)]
    assert max(bytes_of) - min(bytes_of) <= 0.02 * sum(bytes_of) / 16
    assert max(sum(r.virtual_slot == s for r in got) for s in range(256)) < 3000
    again = shard_documents(df.repartition(5), 16, slots=256).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def sharded(rows, shards, slots):
    """shard_documents() in plain Python: (doc_id, size, checksum, shard, slot, virtual slot) of each row."""
    hashed = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % slots
    sized = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    total, mean = sum(r[1] for r in sized), len(sized) / slots
    weight, number = Counter(), Counter(r[0] for r in sized)
    for i, size, _ in sized:
        weight[i] += size
    spread = {i for i in number if i is None or (number[i] > 1 and (weight[i] > total / slots or number[i] > mean))}
    most, seen, placed = min(1000, max(1, len(sized) // slots)), Counter(), []
    for i, size, crc in sized:
        block = seen[(i, size, crc)] // most
        seen[(i, size, crc)] += 1
        placed.append((i, size, crc, hashed("/".join([*([str(i)] if i is not None else []), str(crc), str(block)])) if i in spread else hashed(str(i))))
    loads = Counter()
    for _, size, _, slot in placed:
        loads[slot] += size
    of = {s: s % shards for s in range(slots)}
    for _ in range(slots):
        totals = [sum(loads[s] for s in of if of[s] == d) for d in range(shards)]
        heavy, light = totals.index(max(totals)), totals.index(min(totals))
        gap = totals[heavy] - totals[light]
        if max(totals[heavy] - total / shards, total / shards - totals[light]) <= 0.001 * total / shards:
            break
        fits = [(abs(2 * loads[s] - gap), s) for s in of if of[s] == heavy and 0 < loads[s] < gap]
        if fits:
            of[min(fits)[1]] = light
            continue
        pairs = [(abs(2 * (loads[s] - loads[t]) - gap), s, t) for s in of for t in of if of[s] == heavy and of[t] == light and 0 < loads[s] - loads[t] < gap]
        if not pairs:
            break
        _, s, t = min(pairs)
        of[s], of[t] = light, heavy
    out, filled = [], Counter()
    for i, size, crc, slot in sorted(placed, key=lambda r: (r[3], r[0] is not None, r[0] or 0, r[2], r[1])):
        out.append((i, size, crc, of[slot], filled[of[slot]], slot))
        filled[of[slot]] += 1
    return out


def test_query_against_plain_loops(spark):
    """A table whose null and heavy ids are spread and whose last slots are exchanged."""
    rnd = random.Random(3)
    rows = [(i, "x" * rnd.randrange(4000)) for i in range(150)]
    rows += [(None, f"{i} " + "y" * rnd.randrange(900)) for i in range(40)] + [(None, None)] * 30
    rows += [(5, f"{i} é " + "z" * rnd.randrange(300)) for i in range(60)] + [(8, "same text")] * 50
    got = shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 16, slots=64).collect()
    kind = lambda r: tuple((x is not None, x or 0) for x in r)
    mine = sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot, r.virtual_slot) for r in got), key=kind)
    assert mine == sorted(sharded(rows, 16, 64), key=kind)
