"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary file (ranks of byte-level BPE); a parameter of every operator that counts tokens.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how that vocabulary splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(path: str):  # noqa: ANN201
    """The tokenizer of a vocabulary file, loaded once per Python worker."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, text: str, keep: list[str], path: str = TOKENIZER) -> DataFrame:
    """``keep`` columns and ``n_tokens`` of every row; a null or empty text has none, repeated texts count each.

    Rows stay in their partitions; texts go to Python in Arrow batches and only numbers come back.
    """
    rows = docs.select(*keep, F.col(text).alias("_text"))
    kept = docs.select(*keep).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = encoding(path).encode_ordinary
        for batch in batches:
            out = batch.drop(columns="_text")
            out["n_tokens"] = [len(count(t)) if t else 0 for t in batch["_text"]]
            yield out

    return rows.mapInPandas(run, kept.add("n_tokens", "long"))
