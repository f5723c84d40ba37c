"""Tokens per document, without ever returning an id from a worker."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.encoding import encoder
from subscope.llm.spans import by_bytes


def token_counts(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", limit: int = 2048
) -> DataFrame:
    """Length of every text in tokens: ``key, n_bytes, n_tokens, over_limit``.

    tokenizer: a file of the tokenizers library. Texts are encoded as it does by default, strings of
    special tokens included, with no special token added and nothing truncated.

    Workers take batches of about equal bytes and cut texts where the tokenizer starts anew anyhow, so
    a very long text weighs what its bytes weigh. Null and empty texts have 0 bytes and 0 tokens.
    Repeated rows are counted one by one, a null key is kept, an empty table gives no rows. Only the
    two columns named are read, so others may have any name.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in by_bytes(batches):
            counts = tokens.counts(batch.column("text"))
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), size, pa.array(counts, pa.int64()), pa.array(counts > limit)],
                names=["key", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"key {rows.schema['key'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return rows.mapInArrow(lengths, schema).withColumnRenamed("key", key)
