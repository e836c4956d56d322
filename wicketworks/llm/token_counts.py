"""Token counts of whole texts, encoded in Arrow batches that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wicketworks.llm.pieces import batches_by_bytes, encoder

# Characters encoded together.
BATCH_CHARS = 4 << 20


def token_count(text: Column, tokenizer_path: str, batch_chars: int = BATCH_CHARS) -> Column:
    """Number of tokens of each text, as the library counts them without added special tokens.

    Texts reach the library in batches of about ``batch_chars`` characters, so that a batch costs
    the same whatever its texts' lengths. Each text is cut where a word must begin, so a very
    long text never stands in the library as a whole; its count is the sum over its pieces.
    Null and empty texts have 0 tokens. Special strings inside a text count as the library's default has it.
    """

    @F.arrow_udf("long")
    def counted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = encoder(tokenizer_path, "count")
        for part in parts:
            counts: list[int] = []
            for batch in batches_by_bytes(part.to_pylist(), batch_chars):
                counts.extend(map(sum, counter.encode(batch)))
            yield pa.array(counts, pa.int64())

    return counted(text)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    One pass without a shuffle: every row is counted where it is read. Repeated rows are counted
    each, an empty table gives an empty table, and other columns pass through (columns named like
    the three results are replaced).
    """
    source = F.col(f"`{text}`")
    n_tokens = token_count(source, tokenizer_path)
    kept = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    counted = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce(F.octet_length(source), F.lit(0)).cast("long").alias("n_bytes"),
        n_tokens.alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
