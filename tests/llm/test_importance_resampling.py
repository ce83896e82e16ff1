"""Checksums of word runs, and resampling, against plain loops."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelode.llm import crc_prefix
from tracelode.llm.importance_resampling import importance_resampling, resampled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs_of(text, lo, hi):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("piece", [7, 64, 1_000_000])
def test_run_checksums(monkeypatch, piece):
    monkeypatch.setattr(crc_prefix, "PIECE", piece)
    texts = ["", "--", "One", "x" * 300 + " é ö, 1-2-3", "Ünï cödé A B C d e f g", " ".join(f"w{i}" for i in range(200))]
    found = [crc_prefix.running(t.encode()) for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(c) for c, _ in found])
    crc, end = (np.concatenate(x) for x in zip(*found, strict=True))
    for n in (1, 2, 3, 9):
        got, where = crc_prefix.run_crcs(crc, end, doc, n)
        want = [(i, zlib.crc32(run.encode())) for i, t in enumerate(texts) for run in runs_of(t, n, n)]
        assert list(zip(where.tolist(), got.tolist(), strict=True)) == want


def plain(docs, target, lo, hi, buckets, percent, least):
    fall = lambda t: [zlib.crc32(r.encode()) % buckets for r in runs_of(t, lo, hi)]
    s, t = Counter(b for _, x in docs for b in fall(x)), Counter(b for x in target for b in fall(x))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    out = []
    for i, x in docs:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, fall(x)))
        out.append((i, len(fall(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words(x))))
    can = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = can[: percent * len(can) // 100]
    rows = [(*r[:4], k + 1) for k, r in enumerate(drawn)]
    left = Counter(r[:4] for r in out) - Counter(r[:4] for r in drawn)
    return rows + [(*r, None) for r in left.elements()]


@pytest.mark.parametrize(("lo", "hi", "buckets", "percent"), [(1, 1, 10_000, 10), (1, 3, 97, 35), (2, 2, 70_000, 100)])
def test_against_plain_loops(spark, lo, hi, buckets, percent):
    some = random.Random(hi)
    text = lambda n: " ".join(some.choice("alpha Beta gamma, delta é zeta 42 x-y".split()) for _ in range(n))
    docs = [(i, text(some.randrange(0, 60))) for i in range(150)] + [(7, None), (None, text(40)), (None, ""), (3, "a")]
    docs += [(1, "same words " * 15)] * 40
    target = [text(30) for _ in range(9)] + [None, "Only here"]
    table = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(9).alias("rank"), F.lit("z").alias("a.b"))
    bench = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance_resampling(table.repartition(5), bench, runs=(lo, hi), buckets=buckets, percent=percent)
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(plain(docs, target, lo, hi, buckets, percent, 20), key=order)


def test_rows_with_all_columns_and_odd_tables(spark):
    table = spark.createDataFrame([(i, f"word{i} " * 25, i) for i in range(40)], "doc_id long, text string, `x.y` int")
    bench = spark.createDataFrame([("word3 word4",)], "text string")
    out = resampled(table, bench)
    assert out.columns == table.columns and out.count() == 4
    assert importance_resampling(table.limit(0), bench).count() == 0
    assert importance_resampling(table, bench.limit(0)).where("rank is not null").count() == 4
    few = importance_resampling(spark.createDataFrame([(1, "few words")], "doc_id long, text string"), bench).first()
    assert few["rank"] is None and few.n_features == 2
    with pytest.raises(ValueError, match="lengths"):
        importance_resampling(table, bench, runs=(2, 1))
