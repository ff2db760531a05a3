"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the vocabulary lies on every machine; a parameter everywhere it is used.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's tokenizer divides a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str = RANKS) -> int:
    return len(_encoding(path).encode_ordinary(text)) if text else 0


def token_count(text: Column, path: str = RANKS) -> Column:
    """Tokens of the whole text; 0 for NULL or empty. Special tokens' names are ordinary text."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        enc = _encoding(path)
        return pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)
