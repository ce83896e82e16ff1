"""Jaccard join against all pairs, with every way that regions are joined."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tracelode.llm import jaccard_join as jj


def shingles(text, width=4):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def plain(docs, width=4, percent=85):
    sets = [shingles(t, width) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=str)


def edited(some, words, n):
    words = list(words)
    for _ in range(n):
        words[some.randrange(len(words))] = f"new{some.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, size=160):
    some = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = some.choices(vocabulary, k=60)
    docs = []
    for _ in range(6):
        base = some.choices(vocabulary, k=some.choice([30, 90]))
        docs += [edited(some, base, some.randrange(0, 5)) for _ in range(size // 10)]
        docs += [" ".join(base[: some.randrange(4, len(base))]) for _ in range(4)]
    docs += [" ".join(some.choices(vocabulary, k=20) + passage + some.choices(vocabulary, k=some.randrange(40))) for _ in range(size // 5)]
    docs += [" ".join(passage) + " tail" * (i % 9) for i in range(12)]
    docs += ["", None, " \t\n", "One", "one", "one two", "One  Two\x0bthree", "é è à", "É è à", "x\x85y z", "a b c d", "a b c d e"]
    some.shuffle(docs)
    rows = list(enumerate(docs)) + [(None, docs[0]), (None, "of no id at all here"), (3, docs[3]), (3, docs[5])]
    return rows


SIZES = {
    "plain": {},
    "small leaves": {"leaf": 4, "pivots": 2, "crowd": 3},
    "blocks": {"leaf": 3, "pivots": 50, "crowd": 3},
    "by weight": {"leaf_shingles": 200, "pivots": 3, "crowd": 5},
    "by exchange": {"few": 0, "leaf": 10},
    "one bucket of counts": {"counts": 1, "leaf": 12, "pivots": 4},
}


@pytest.mark.parametrize("kind", SIZES)
def test_against_all_pairs(spark, kind):
    docs = corpus(sorted(SIZES).index(kind))
    table = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("x"), F.lit(1).alias("a.b"))
    got = jj.jaccard_components(table.repartition(5), **SIZES[kind]).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain(docs)


@pytest.mark.parametrize(("width", "percent"), [(1, 50), (5, 80), (2, 100)])
def test_other_widths_and_limits(spark, width, percent):
    docs = corpus(9, 60)
    got = jj.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), width=width, percent=percent, leaf=8)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str) == plain(docs, width, percent)


@pytest.mark.parametrize("piece", [5, 23, 64])
def test_long_texts_are_read_piece_by_piece(monkeypatch, piece):
    texts = [" ".join(f"w{i % 50}" for i in range(500)) + "\t" + "x" * 90, "", "y" * 200, None, "a  b c D e" + " " * 70, " " * 64, "x" * 64 + " z"]
    texts = [t if t is None else t.encode() for t in texts]
    whole = list(jj.shingle_sets(texts))
    monkeypatch.setattr(jj, "PIECE", piece)
    assert [x.tolist() for x in jj.shingle_sets(texts)] == [x.tolist() for x in whole]
    assert [len(x) for x in whole] == [len(shingles(t.decode() if t else t)) for t in texts]


def test_empty_table(spark):
    assert jj.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("few", [0, 10**6])
def test_rows_of_asked_keys_are_near(spark, few):
    rows = spark.range(200_000).selectExpr("id as x", "cast(id as string) as name")
    keys = spark.range(0, 200_000, 1000)
    for column, asked in (("x", keys), ("name", keys.selectExpr("cast(id as string) as k"))):
        near = jj._near(rows, column, asked, few)
        assert near.columns == rows.columns and near.where("x % 1000 = 0").count() == 200 and near.count() < 3000
    assert jj._near(rows, "x", keys.limit(0), few).count() == 0


def test_sets_with_few_shingles_in_common(spark):
    """Links of less than eight shingles in common, of sets of more than eight."""
    docs = [(1, "a b c d e f g h i"), (2, "a b c d e f g x y"), (3, "p q r s t u v w"), (4, "p q r s k l m n")]
    got = jj.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), width=1, percent=50)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect())) == plain(docs, 1, 50) == [(1, 9, 1), (2, 9, 1), (3, 8, 3), (4, 8, 4)]


@pytest.mark.parametrize("few", [0, 10**6])
def test_keys_are_counted_once(spark, few):
    keys, counted = spark.range(50_000), []

    class Counted(type(keys)):
        def count(self):
            counted.append(1)
            return super().count()

    keys = Counted(keys._jdf, spark)
    assert jj._near(spark.range(60_000).toDF("x"), "x", keys, few).count() >= 50_000 and counted == [1]


def test_levels_are_logarithms_of_counts(spark):
    texts = spark.createDataFrame([(b"a a a a b", 1, "k"), (b"a a a a", 2, "l"), (None, 3, "m")], "text binary, doc_id long, text_key string")
    rows, levels = jj._outlines(texts.repartition(3), 4, 1 << 10)
    assert levels.dtype == "float32" and len(levels) == 1 << 10 and sorted(levels[levels > 0].tolist()) == pytest.approx([1.0, 1.5849625])
    assert sorted(r["n"] for r in rows.collect()) == [0, 1, 2]


def reps_of(spark, texts, counts=jj.COUNTS, percent=85):
    table = spark.createDataFrame([(t.encode(), i, str(i)) for i, t in enumerate(texts)], "text binary, doc_id long, text_key string").repartition(3)
    rows, levels = jj._outlines(table, 4, counts)
    return table, rows, jj._representatives(table, levels, 4, percent)


def test_windows_hold_rare_shingles_of_a_crowded_table_of_counts(spark):
    """Entries hold about 145 shingles each; those of a passage, 30 more, must not pass for rare ones."""
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [" ".join(f"d{d}w{i}" for i in range(230)) + " " + passage for d in range(30)]
    shared = set(next(jj.shingle_sets([passage.encode()])).view("int64").tolist())
    _, _, reps = reps_of(spark, texts, counts=48)
    windows = [r["first"] for r in reps.collect()]
    assert len(windows) == 30 and {len(w) for w in windows} == {jj.window(257)}
    assert sum(len(shared & set(w)) for w in windows) < 30


def test_pairs_that_meet_too_rarely_are_no_pairs(spark):
    """Two long texts with thirteen shingles of 1997 in common, in both windows, and two near copies."""
    some = [" ".join(f"d{d}w{i}" for i in range(1000)) + " " + " ".join(f"c{i}" for i in range(16)) + " " + " ".join(f"d{d}v{i}" for i in range(984)) for d in range(2)]
    near = [" ".join(f"n{i}" for i in range(400)) + tail for tail in ("", " and a tail")]
    table, rows, reps = reps_of(spark, [*some, *near])
    # The shared ones come first, so that they are in both windows.
    shared = next(jj.shingle_sets([" ".join(f"c{i}" for i in range(16)).encode()])).view("int64").tolist()
    first = F.array_union(F.array_intersect("first", F.array(*map(F.lit, shared))), "first")
    reps = reps.withColumn("first", F.when(F.col("n") > 1000, F.slice(F.array_union(F.array(*map(F.lit, shared)), first), 1, jj.window(1997))).otherwise(F.col("first")))
    _, pairs = jj._meetings(reps, 85, jj.CROWD, jj.FEW)
    sizes = {r["key"]: r["n"] for r in reps.collect()}
    assert [sorted((sizes[r["region"]], sizes[r["x"]])) for r in pairs.collect()] == [[397, 400]]


def test_no_link_is_lost_by_how_often_windows_meet(spark):
    some = random.Random(5)
    rows = []
    for percent in (50, 85, 100):
        for _ in range(3000):
            both, a, b = some.randrange(1, 120), some.randrange(0, 25), some.randrange(0, 25)
            order = some.sample(range(10**6), both + a + b)
            x, y = sorted(order[: both + a]), sorted(order[:both] + order[both + a :])
            times = len({*x[: jj.window(len(x), percent)]} & {*y[: jj.window(len(y), percent)]})
            rows.append((percent, len(x), len(y), times, 100 * both >= percent * (both + a + b)))
    for percent in (50, 85, 100):
        table = spark.createDataFrame([r[1:] for r in rows if r[0] == percent], "n_region long, n_x long, times long, links boolean")
        kept = table.where(jj._may_link(percent))
        assert kept.where("links").count() == table.where("links").count() > 0
        assert percent == 50 or kept.where("not links").count() < table.where("not links").count()


def test_meetings_are_counted_as_by_plain_rows(spark):
    some = random.Random(7)
    rows = [(k * 1001, some.sample(range(-300, 300), some.randrange(0, 40))) for k in range(500)]
    reps = spark.createDataFrame(rows, "key long, first array<long>").repartition(3)
    cells = {}
    for key, first in rows:
        for s in first:
            cells.setdefault(s, []).append(key)
    got = {r["s"]: (r["a"], r["b"], r["all"], r["n"]) for r in jj._met(reps).collect()}
    want = {}
    for s, keys in cells.items():
        every = 0
        for key in keys:
            every ^= key
        want[s] = (min(keys), max(keys), every, len(keys))
    assert got == want and jj._met(reps.limit(0)).count() == 0


def test_one_copy_of_a_text_is_asked_for(spark, monkeypatch):
    """A thousand copies of each of two near texts: the exchange of texts takes hardly more than one of each."""
    texts = [" ".join(f"n{i}" for i in range(400)) + tail for tail in ("", " and a tail")]
    docs = spark.createDataFrame([(t, 2 * i + k) for i in range(1000) for k, t in enumerate(texts)], "text string, doc_id long").repartition(4)
    near, passed = jj._near, []
    monkeypatch.setattr(jj, "_near", lambda rows, column, keys, few: [out := near(rows, column, keys, few), passed.append(out.count()) if "text" in rows.columns else None][0])
    got = jj.jaccard_components(docs).groupBy("component_id").count().collect()
    assert [tuple(r) for r in got] == [(0, 2000)] and len(passed) == 1 and passed[0] < 40
