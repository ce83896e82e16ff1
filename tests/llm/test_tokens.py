"""Byte-level BPE and token counts against the libraries."""

from __future__ import annotations

import base64
import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tracelode.llm import byte_bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = st.text(alphabet=st.sampled_from(list("aAsStremvldl'’ \n\r\t\x0b\x1c\x1f\x85\u2028\u3000\u00a0.,!?12²Ⅷé漢\u0301\u200b\0😀ſ")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(ODD, st.text(st.characters(exclude_categories=["Cs"]), max_size=20)), max_size=5))
def test_encoding_equals_the_library(texts):
    coder = byte_bpe.codec(RANKS)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    for text, ids in zip(texts, coder.encode(texts) if texts else [], strict=True):
        assert list(ids) == lib.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
        offsets = coder.offsets(ids)
        assert [coder.bytes_of[i] for i in ids] == [text.encode()[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "漢字" * 2000, "'" * 1000, " " * 3000, "x" * 200 + " y", "'re've'll's" * 50])
def test_long_pieces(library, text):
    (ids,) = byte_bpe.codec(RANKS).encode([text])
    assert list(ids) == library.encode_ordinary(text)


def test_scan_equals_a_loop():
    f = np.random.default_rng(1).choice([byte_bpe.OPENS, byte_bpe.HOLDS, byte_bpe.TAKES_ONE, byte_bpe.TAKES_TWO], 1000).astype(np.uint8)
    state, want = byte_bpe.FREE, []
    for x in f:
        want.append(state)
        state = int(x) >> 2 * state & 3
    assert (byte_bpe.scan(f, 8) & 3).tolist() == want


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 9) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens int")


def test_rows_in_every_form(spark, library):
    texts = ["hello world", None, "", "hello world", "y " * 30000, "it's\n\n ok "]
    docs = frame(spark, texts)
    docs = docs.union(docs.where("doc_id = 0")).union(docs.where("doc_id = 0").selectExpr("null", "text", "ids", "n_tokens"))
    coded = byte_bpe.encode_texts(docs, RANKS)
    rows = coded.collect()
    assert len(rows) == 8
    for r in rows:
        text = texts[r.doc_id or 0] or ""
        want = library.encode_ordinary(text)
        assert r.ids == want
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = byte_bpe.decode_ids(coded, RANKS).collect()
    assert sorted((r.text for r in back)) == sorted((texts[r.doc_id or 0] or "") for r in rows)
    assert all(r.offsets_fit for r in back)
    assert byte_bpe.encode_texts(docs.limit(0), RANKS).count() == 0


def plain(path):
    """Counts by the library alone, text by text."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    return lambda text: len(library.encode(text, add_special_tokens=False))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(ODD, st.sampled_from(["<|endoftext|>", " a<|endoftext|> b", "a b", "x\n y", "x\ny", "Σας Σ"])), min_size=1, max_size=6))
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
@pytest.mark.parametrize("most", [3, 20, 200_000])
def test_counts_equal_the_library(name, most, texts):
    path = public_tokenizers.path(name)
    joined = [*texts, " ".join(texts), "".join(texts), "\n".join(texts)]
    key = (name, most)
    if key not in KNOWN:
        KNOWN[key] = (token_counts.Counter(path, most), plain(path))
    tally, count = KNOWN[key]
    assert tally.count([(t, len(t.encode())) for t in joined]) == [count(t) for t in joined]


KNOWN: dict = {}


def test_only_proven_tokenizers_are_split(tmp_path):
    """A tokenizer that puts a blank before every piece would count more if it were cut."""
    with open(JSON, encoding="utf-8") as f:
        spec = json.load(f)
    assert token_counts.splits_safely(spec)
    assert not token_counts.splits_safely(json.load(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8")))
    others = [
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": False, "trim_offsets": True}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True, "trim_offsets": True}},
        {"pre_tokenizer": None},
        {"normalizer": {"type": "NFKC"}},
        {"added_tokens": [dict(spec["added_tokens"][0], content="a b")]},
    ]
    for change in others:
        assert not token_counts.splits_safely(spec | change), change
    path = str(tmp_path / "prefix.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec | others[0], f)
    text = "one two\nthree four " * 5
    assert token_counts.Counter(path, 8).count([(text, len(text))]) == [plain(path)(text)]


def test_long_texts_are_split():
    text = "some words\nand lines  of text " * 200
    parts = list(token_counts.pieces(text, 100))
    assert "".join(parts) == text and len(parts) > 20 and all(100 <= len(p) < 120 for p in parts[:-1])
    assert list(token_counts.pieces("x" * 1000, 100)) == ["x" * 1000]


def test_count_rows(spark):
    docs = frame(spark, ["hello <|endoftext|> world", None, "", "é " * 40000])
    rows = {r.doc_id: r for r in token_counts.token_counts(docs.union(docs.where("doc_id = 1")), JSON).collect()}
    assert rows[0].n_tokens == plain(JSON)("hello <|endoftext|> world")
    assert (rows[1].n_bytes, rows[1].n_tokens, rows[1].over_limit) == (0, 0, False)
    assert (rows[3].n_bytes, rows[3].over_limit) == (120000, True)
    assert token_counts.token_counts(docs.limit(0), JSON).count() == 0
