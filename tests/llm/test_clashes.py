"""Stages over tables whose columns are called like anything inside them, empty tables, missing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tracelode.llm import byte_bpe, decontaminate, secret_scan, simhash_dedup, toxicity
from tracelode.llm.common import cut

NAMES = (
    "row id key bad_id bad_key keep_id keep_key n component hide s_id s_key new copied _keep_id _keep_key _keep_n _s_hide _s_id _s_key "
    "_bad_id _bad_key rid owner repo base hash spans fp text_key component_id w n_words place h items score predicted held_out toxic words"
).split() + ["x.y", "a b", "tick`ed"]
WORDS = "once upon a time there was some text with words that make a window of thirteen words or more".split()


def table(spark):
    rows = [
        (1, " ".join(WORDS), "s0", "en"),
        (2, " ".join(WORDS), "s1", "en"),
        (3, None, "s1", None),
        (4, "", None, "en"),
        (5, "a vile insult, token = 9f8e7d6c5b4a39281706f5e4d3c2b1a0", "s2", "de"),
        (6, "some other words of no note at all", "s2", "de"),
        (None, "text of no id", "s2", "de"),
    ]
    rows += rows[4:5]
    some = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    return some.select("*", *[F.lit(7).alias(n) for n in NAMES])


def stages(spark, docs):
    bench = spark.createDataFrame([(1, "some other words of no note at all"), (None, "x"), (2, None)], "item_id long, text string")
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    return {
        "toxicity": toxicity.clean_documents(docs, labels),
        "near": simhash_dedup.deduplicated(docs),
        "bench": decontaminate.decontaminated(docs, bench),
        "secrets": secret_scan.redacted(docs),
    }


def test_clashing_columns(spark):
    docs = table(spark)
    out = stages(spark, docs)
    for name, got in out.items():
        assert got.columns == docs.columns, name
        assert {r[n] for r in got.select(*[f"`{n.replace('`', '``')}`" for n in NAMES]).collect() for n in NAMES} == {7}
    ids = {name: sorted(str(r.doc_id) for r in got.select("doc_id").collect()) for name, got in out.items()}
    assert ids["near"] == ["1", "3", "5", "6", "None"]
    assert ids["bench"] == ["1", "2", "3", "4", "5", "5", "None"]
    assert ids["secrets"] == sorted(map(str, [1, 2, 3, 4, 5, 5, 6, None]))
    texts = {r.doc_id: r.text for r in out["secrets"].collect()}
    assert texts[5] == "a vile insult, token = <secret>" and texts[3] is None


def test_empty_tables(spark):
    docs = table(spark).limit(0)
    for name, got in stages(spark, docs).items():
        assert got.count() == 0 and got.columns == docs.columns, name
    assert byte_bpe.encode_texts(docs.select("doc_id", "text"), __import__("public_tokenizers").path("byte_bpe_50k.tiktoken")).count() == 0


@pytest.mark.parametrize("columns", [["doc_id", "text"], ["doc_id", "text", "source"], ["doc_id", "text", "lang"]])
def test_secrets_without_owner_columns(spark, columns):
    docs = table(spark).select(*columns)
    got = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert got[5] == "a vile insult, token = <secret>" and len(got) == 7
    assert secret_scan.secret_scan(docs).count() == 8


def test_many_repositories_of_two_owners_are_copies(spark):
    value = "password=9f8e7d6c5b4a39281706"
    rows = [(i, value, f"s{i % 2}", f"l{i // 2}") for i in range(4)] + [(9, value.replace("9f", "7a"), "s0", f"l{i}") for i in range(4)]
    docs = cut(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"))
    kinds = {r.doc_id: {s["kind"] for s in r.spans} for r in secret_scan.secret_scan(docs).collect()}
    assert "example" in kinds[0] and "live" not in kinds[9] and "example" not in kinds[9]
    few = {r.doc_id: {s["kind"] for s in r.spans} for r in secret_scan.secret_scan(docs.where("lang = 'l0'")).collect()}
    assert "example" not in few[0] and "live" in few[9]
