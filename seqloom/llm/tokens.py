"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A vocabulary of byte-pair ranks; another path may be given everywhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern by which that vocabulary's texts are cut beforehand.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("sizes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str = VOCABULARY) -> int:
    """Tokens of one text; 0 for null and empty."""
    return len(_encoding(path).encode_ordinary(text)) if text else 0


def with_tokens(df: DataFrame, key: str, text: str, keep: tuple[str, ...] = (), path: str = VOCABULARY) -> DataFrame:
    """(key, keep..., n_tokens); whole texts, 0 tokens for null and empty ones."""
    columns = [key, *keep]
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [count_tokens(t.as_py(), path) for t in batch["_text"]]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), pa.array(sizes, pa.int64())], names=[*columns, "n_tokens"])

    return df.select(*columns, F.col(text).cast("string").alias("_text")).mapInArrow(run, f"{fields}, n_tokens long")
