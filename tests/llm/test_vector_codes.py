"""Vector codes against plain loops: transform, nearest entries, whole rounds, odd inputs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelode.llm import vector_codes as vc


def changes(row) -> int:
    return int((np.sign(row[1:]) != np.sign(row[:-1])).sum())


@pytest.mark.parametrize("size", [1, 2, 4, 16, 32])
def test_coefficients_in_order_of_sequency(size):
    rows = vc.walsh(np.eye(size, dtype=np.int64)).T
    assert [changes(r) for r in rows] == list(range(size))


@pytest.mark.parametrize("width", [1, 3, 4, 7, 16, 21])
def test_nearest_against_all_distances(width):
    rng = np.random.default_rng(width)
    rows, entries = rng.integers(-9, 9, (300, width)), rng.integers(-9, 9, (50, width))
    entries[7] = entries[30]
    at, error = vc.nearest(rows, entries)
    exact = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (at == exact.argmin(axis=1)).all() and (error == exact.min(axis=1)).all()
    large, far = vc.nearest(rows * 2**40, entries * 2**40)
    assert (large == at).all() and [int(x) for x in far] == [int(x) << 80 for x in error]


def plain(vectors, parts, entries, rounds):
    """Codes, errors and the last codebooks of (id, whole vector) pairs, ids in order."""
    width = -(-max(len(v) for _, v in vectors) // parts) * parts
    size = width // parts
    cut = [[(list(v) + [0] * (width - len(v)))[p * size : (p + 1) * size] for p in range(parts)] for _, v in vectors]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    for turn in range(rounds + 1):
        near = [[min(range(len(books[p])), key=lambda e, p=p, c=c: (far(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]
        if turn == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, n in zip(cut, near, strict=True) if n[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    codes = ["".join(f"{e:02x}" for e in n) for n in near]
    errors = [sum(far(c[p], books[p][n[p]]) for p in range(parts)) for c, n in zip(cut, near, strict=True)]
    return codes, errors, books


@pytest.mark.parametrize("dims", [(8,), (6,), (3, 9, 10)])
def test_rounds_against_plain_loops(spark, dims):
    some = random.Random(len(dims))
    rows = [(i, [some.uniform(-2, 2) for _ in range(some.choice(dims))], some.choice([0, 1, None])) for i in range(120)]
    rows += [(200, None, 1), (201, [1.0, None], 1), (202, [float("nan")] * 8, 1), (203, [float("inf")] * 8, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select("*", F.lit(1).alias("v"), F.lit(2).alias("a.b"))
    got = {r.vec_id: r for r in vc.vector_codes(table.repartition(3), entries=16, rounds=3).collect()}
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v, _ in rows[:120]]
    codes, errors, books = plain(whole, 4, 16, 3)
    assert [got[i].code for i, _ in whole] == codes and [got[i].error for i, _ in whole] == errors and len(got) == 120
    sums = {label: sum(e for e, r in zip(errors, rows, strict=False) if r[2] == label) for label in (0, 1, None)}
    assert {i: got[i].label_error for i, _ in whole} == {i: sums[rows[i][2]] for i, _ in whole}
    numbers = vc.Codebooks(0, tuple(np.array(b) for b in books)).sha256()
    assert {r.codebooks_sha256 for r in got.values()} == {numbers}


def test_labels_by_exchange_and_decoding(spark):
    rows = [(i, [float(i % 5), 1.0, -1.0, 0.5], i % 3 or None) for i in range(60)]
    used = vc.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    books = vc.train(used, entries=8)
    codes = vc.encode(used, books)
    sort = lambda df: sorted(map(tuple, df.select("vec_id", "label_error").collect()))
    assert sort(vc.with_label_error(codes, few=1)) == sort(vc.with_label_error(codes))
    back = {r.vec_id: r for r in vc.decode(codes, books).collect()}
    for i, v, _ in rows:
        assert sum((int(np.floor(1024 * x)) - y) ** 2 for x, y in zip(v, back[i].v, strict=True)) == back[i].error


def test_empty_few_and_very_large(spark):
    kind = "vec_id long, embedding array<double>, label int"
    assert vc.vector_codes(spark.createDataFrame([], kind)).count() == 0
    assert vc.vector_codes(spark.createDataFrame([(1, None, 1), (None, [None], None)], kind)).count() == 0
    got = {r.vec_id: r for r in vc.vector_codes(spark.createDataFrame([(None, [1.0] * 4, None), (None, [1.0] * 4, None), (5, [], 1), (2, [1e300] * 4, 2)], kind)).collect()}
    assert len(got) == 3 and got[2].error == 0 and got[None].error == 0
    assert vc.vector_codes(spark.createDataFrame([(1, [1.0] * 4)], "vec_id long, embedding array<double>")).first().label_error == 0
