"""The registered queries of the training-data operators, and SQL where SQL can state them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from tracelode.llm import oracles
from tracelode.llm.byte_bpe import encode_texts
from tracelode.llm.common import table
from tracelode.llm.decontaminate import contamination
from tracelode.llm.importance_resampling import importance_resampling
from tracelode.llm.jaccard_join import jaccard_components
from tracelode.llm.license_scan import license_scan
from tracelode.llm.secret_scan import base_spans, joined_spans, secret_scan
from tracelode.llm.sharding import shard_documents
from tracelode.llm.simhash_dedup import near_duplicates
from tracelode.llm.simhash_sql import SIMHASH
from tracelode.llm.token_counts import token_counts
from tracelode.llm.topk_search import exact_topk
from tracelode.llm.toxicity import toxicity
from tracelode.llm.url_filter import Rule, judged_urls, url_filter_sql
from tracelode.llm.vector_codes import vector_codes

URL_RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]


def op1_secret_scan(spark, sf_dir):
    found = secret_scan(table(spark, sf_dir, "documents"))
    base = base_spans(F.col("spans"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


def op2_topk_search(spark, sf_dir):
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_virtual_slots(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"), 16)


def op4_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    coded = encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), keep_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op6_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash_dedup(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_license_scan(spark, sf_dir):
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", "families", "n_paragraphs", "n_confirmed", "n_unconfirmed", "unconfirmed")


def op9_decontaminate(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op10_url_filter(spark, sf_dir):
    return judged_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_vector_codes(spark, sf_dir):
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark, sf_dir):
    return importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_topk_search": op2_topk_search,
    "op3_virtual_slots": op3_virtual_slots,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_token_counts": op5_token_counts,
    "op6_toxicity": op6_toxicity,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_decontaminate": op9_decontaminate,
    "op10_url_filter": op10_url_filter,
    "op11_vector_codes": op11_vector_codes,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_jaccard_join": op13_jaccard_join,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_secret_scan": oracles.SECRET_SCAN,
    "op2_topk_search": oracles.TOPK_SEARCH,
    "op3_virtual_slots": oracles.SHARDS,
    "op7_simhash_dedup": SIMHASH,
    "op9_decontaminate": oracles.DECONTAMINATE,
    "op10_url_filter": url_filter_sql(URL_RULES),
    "op11_vector_codes": oracles.VECTOR_CODES,
    "op12_importance_resampling": oracles.IMPORTANCE,
    "op13_jaccard_join": oracles.JACCARD,
}
