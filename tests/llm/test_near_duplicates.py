"""SimHash components against plain loops."""

from __future__ import annotations

import random

import pytest
import xxhash

from tracelode.llm import simhash_dedup as d
from tracelode.llm.components import connected_components


def slow_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, joined):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in joined:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \x0b\n", "One", "one TWO", "a b c", "a b c d É\u00a0x", "w " * 300, "é ß İ K"])
def test_fingerprint(text):
    assert d.fingerprint(text) % 2**64 == slow_print(text)


def clouds(seed, n_clouds, size):
    rnd = random.Random(seed)
    out = set()
    for _ in range(n_clouds):
        now = rnd.getrandbits(64)
        for _ in range(size):
            out.add(now - 2**64 if now >= 2**63 else now)
            for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 4])):
                now ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("paired", [400, 2, 0])
def test_links_give_the_components_of_all_pairs(spark, paired):
    prints = clouds(5, 12, 18)
    rnd = random.Random(1)
    # One crowd that shares a whole segment, a few bits apart in the other.
    centre = rnd.getrandbits(64)
    for _ in range(60):
        x = centre
        for b in rnd.sample(range(32), rnd.choice([0, 1, 2, 3])):
            x ^= 1 << b
        prints.append(x - 2**64 if x >= 2**63 else x)
    prints = sorted(set(prints))
    near = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if ((a ^ b) % 2**64).bit_count() <= 3]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = d.links(df, paired)
    got_pairs = {(r.u, r.v) for r in found.collect()}
    assert all(((a ^ b) % 2**64).bit_count() <= 3 for a, b in got_pairs)
    got = {r.node: r.root for r in connected_components(found).collect()}
    want = roots(prints, near)
    assert {p: got.get(p, p) for p in prints} == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000)] + [(7, 6)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(400)}
    assert connected_components(df.limit(0)).count() == 0


def documents(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for g in range(6):
        body = [rnd.choice(words) for _ in range(300)]
        for k in range(4):
            copy = list(body)
            if k:
                copy[rnd.randrange(300)] = "changed"
            texts[10 * g + k + 1] = " ".join(copy)
    texts |= {100: None, 101: "", 102: " \n"}
    rows = [(i, t, "x") for i, t in texts.items()] + [(1, texts[1], "x"), (None, texts[11], "x"), (None, "alone null id", "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, fp string")


def test_near_duplicates(spark):
    rows, df = documents(spark)
    prints = [slow_print(t) for _, t, _ in rows]
    index = range(len(rows))
    joined = [(a, b) for a in index for b in index if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    root = roots(index, joined)
    least = {}
    for i in index:
        if rows[i][0] is not None:
            least[root[i]] = min(least.get(root[i], 10**9), rows[i][0])
    want = sorted((str(rows[i][0]), prints[i], str(least.get(root[i]))) for i in index)
    got = d.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in got) == want
    kept = d.deduplicated(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(root.values()))
    assert d.near_duplicates(df.limit(0)).count() == 0
    assert d.deduplicated(df.limit(0)).count() == 0
