"""Token counts of documents: batch encoding that returns lengths only."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from fleetbook.llm.common import text_batches
from fleetbook.llm.encoding import encoder


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text", chunk_bytes: int = 1 << 20) -> DataFrame:
    """Per row: the id, UTF-8 bytes, tokens of the whole text, and whether the
    tokens exceed ``limit``. ``tokenizer`` is a file path readable on every
    executor.

    One map over the scan, no shuffle: scan splits and the runs of rows inside
    an Arrow batch are balanced by bytes, long texts are cut at safe
    boundaries (see ``encoding``), and only numbers come back to the JVM.
    A null text counts as empty (0 bytes, 0 tokens); repeated rows and null
    ids are each returned; an empty table gives no rows; other columns are not
    read.
    """
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches):
        encode = encoder(tokenizer, ids=False)
        for rows, texts in text_batches(batches, chunk_bytes):
            n_tokens = pa.array(encode(texts), pa.int64())
            n_bytes = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.record_batch(
                [rows.column(0), n_bytes, n_tokens, pc.greater(n_tokens, limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(count, schema)
