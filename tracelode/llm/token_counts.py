"""Token counts: batch encoding in an Arrow function that returns lengths only.

Texts go to the library whole, in batches of about equal bytes. A text longer than a batch is split
first, at places where the tokenizer starts a new piece whatever stands around; that is done only for
tokenizers whose file proves such places (see splits_safely()), other long texts are a batch each.
Memory is bounded by the batch size and the longest single text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import map_arrow

#: UTF-8 bytes that one call of the library encodes, about; longer texts are split into pieces of it.
BATCH_BYTES = 200_000
#: A safe boundary: before a blank or line feed between two characters that are not white space.
SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")


def splits_safely(spec: dict) -> bool:
    """Whether a ``tokenizers`` file starts a new piece at every SAFE place: byte-level pre-tokenising by
    its own pattern and without a blank put in front, nothing normalised, and no added token that
    holds white space or looks at its neighbours."""
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    model = spec.get("model") or {}
    whole = model.get("type") == "BPE" and not any(model.get(x) for x in ("continuing_subword_prefix", "end_of_word_suffix", "dropout"))
    added = spec.get("added_tokens") or []
    alone = not any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
    return bool(plain and whole and alone and not spec.get("normalizer"))


def pieces(text: str, most: int) -> Iterator[str]:
    """`text` in pieces of `most` characters at least, but for the last, cut at safe boundaries."""
    start = 0
    while len(text) - start > most:
        found = SAFE.search(text, start + most)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Counter:
    """Counts of whole texts by one tokenizer file: ``.model`` by sentencepiece, others by tokenizers."""

    def __init__(self, path: str, most: int = BATCH_BYTES):
        self.most = most
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode, self.splits = lambda texts: map(len, model.encode(texts, num_threads=1)), False
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.encode = lambda texts: map(len, library.encode_batch_fast(texts, add_special_tokens=False))
        with open(path, encoding="utf-8") as file:
            self.splits = splits_safely(json.load(file))

    def count(self, texts: Iterable[tuple[str | None, int]]) -> list[int]:
        """Counts of (text, bytes) pairs, in order."""
        counts: list[int] = []
        batch: list[str] = []
        owner: list[int] = []
        size = 0

        def flush() -> None:
            for i, n in zip(owner, self.encode(batch), strict=True):
                counts[i] += n
            batch.clear()
            owner.clear()

        for text, n_bytes in texts:
            counts.append(0)
            for piece in pieces(text or "", self.most) if self.splits and n_bytes > self.most else [text or ""]:
                # A text that is not split has its own bytes; a piece has four a character at most.
                held = n_bytes if piece is text else 4 * len(piece)
                if batch and size + held > self.most:
                    flush()
                    size = 0
                batch.append(piece)
                owner.append(len(counts) - 1)
                size += held
        if batch:
            flush()
        return counts


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter for each Python worker and file."""
    return Counter(path)


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
) -> DataFrame:
    """One row per row of `docs`: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `tokenizer` is the path of a ``tokenizers`` file, or of a sentencepiece ``.model``, on the workers; it
    is counted without added special tokens, truncation or padding, special strings in texts as the
    library's default has them. Null text counts as empty (0 bytes, 0 tokens); null ids stay; repeated
    rows each give a row; an empty table gives an empty one; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = counter(tokenizer)
        for batch in batches:
            counts = tally.count(zip((x.as_py() for x in batch.column(1)), batch.column(2).to_pylist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(f"`{text_col}`")
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = map_arrow(narrow, run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
