"""The corpus pipeline, stage by stage, on the smallest tables."""

from __future__ import annotations

import os

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tracelode.llm.common import table

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs = table(spark, SF, "documents")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp(f"stage{i}") / "t")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns_and_shrinking(results):
    for before, after in zip(results[:-2], results[1:-1], strict=True):
        assert after.columns == before.columns
        assert after.count() <= before.count()
    assert results[-1].count() == results[-2].count()
    assert results[3].count() == results[4].count()


def test_toxicity_equals_a_plain_loop(spark, results):
    """The documents kept are those that a loop over the fitted model's words leaves."""
    from tracelode.llm import toxicity

    docs = results[0].select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, SF, "labels"), usable=~toxicity.held_out(F.col("doc_id")))
    rows = docs.collect()
    assert sorted(r.doc_id for r in results[1].select("doc_id").collect()) == sorted(r.doc_id for r in rows if model.score(r.text) < 0.7)


def test_redaction_equals_a_plain_loop(results):
    """Values found by loops, owners and repositories counted in dictionaries, texts replaced one by one."""
    from tests.llm.test_secret_scan import base
    from tracelode.llm.secret_scan import WIDE_OWNERS, WIDE_REPOS

    rows = results[3].collect()
    owners, repos = {}, {}
    for r in rows:
        for *_, value in base(r.text):
            owners.setdefault(value, set()).add(r.source or "")
            repos.setdefault(value, set()).add((r.source or "", r.lang))
    copied = {v for v, o in owners.items() if len(o) >= WIDE_OWNERS or (len(o) > 1 and len(repos[v]) >= WIDE_REPOS)}
    want = {}
    for r in rows:
        found = [(stop - len(value), stop, value) for _, _, _, stop, value in base(r.text)]
        spared = {(a, b) for a, b, v in found if v in copied}
        out, at = "", 0
        for a, b in sorted({(a, b) for a, b, _ in found} - spared):
            if a >= at:
                out += (r.text or "")[at:a] + "<secret>"
            at = max(at, b)
        want[r.doc_id] = out + r.text[at:] if found and r.text else r.text
    got = {r.doc_id: r for r in results[4].collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for i, r in got.items() if r.text and r.text != next(x.text for x in rows if x.doc_id == i))


def test_one_of_each_group_stays(spark, results):
    from tracelode.llm.simhash_dedup import near_duplicates

    groups = near_duplicates(results[1]).select("component_id").distinct()
    assert sorted(r.doc_id for r in results[2].select("doc_id").collect()) == sorted(r.component_id for r in groups.collect())


def test_no_benchmark_is_left(spark, results):
    from tracelode.llm.decontaminate import contamination

    bench = table(spark, SF, "benchmark")
    assert contamination(results[3], bench).where("contaminated").count() == 0
    assert results[2].count() - results[3].count() == contamination(results[2], bench).where("contaminated").count()


def test_tokens_decode(spark, results):
    import public_tokenizers

    from tracelode.llm.byte_bpe import decode_ids

    back = decode_ids(results[5], public_tokenizers.path("byte_bpe_50k.tiktoken"))
    met = back.withColumnRenamed("text", "decoded").join(results[4].select("doc_id", "text"), "doc_id")
    assert met.where("decoded = text and offsets_fit").count() == results[4].count()


def test_run_is_the_stages(spark, results):
    got = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, results[5].select("doc_id", "ids_sha256").collect()))
