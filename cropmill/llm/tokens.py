"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Place of the vocabulary, a rank file of byte-level BPE; a parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that splits text before the merges of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def _encoding(data: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("cropmill", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(docs: DataFrame, column: str = "text", name: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """Append the number of tokens of the whole text; 0 for null and empty texts. The vocabulary (under 1 MB) is broadcast."""
    with open(vocabulary, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = _encoding(shipped.value)
        for s in batches:
            yield s.map(lambda t: len(encoding.encode_ordinary(t)) if t else 0).astype("int64")

    # A deterministic function would be computed again for every filter on its result.
    counted = F.pandas_udf(count, "bigint").asNondeterministic()
    return docs.withColumn(name, counted(F.coalesce(F.col(column), F.lit(""))))
