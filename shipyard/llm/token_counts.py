"""Token counts of whole texts by rank-synchronous array merging.

The pre-tokens of a batch stand in ragged numpy arrays; every round merges the
lowest-ranked pair of all sequences at once (``bpe.ByteBpe``), and the surviving
symbols are counted. No shuffle: one pass over the documents.

A null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated
rows are counted each; an empty table gives an empty table. Strings of special
tokens inside a text count as one token, as the tokenizer file has it by default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from shipyard.llm import bpe
from shipyard.llm.bytetext import flat
from shipyard.llm.common import ready, text_chunks


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``."""
    ready(docs.sparkSession)
    schema = StructType(
        [
            StructField(id_col, docs.schema[id_col].dataType),
            StructField("n_bytes", LongType()),
            StructField("n_tokens", LongType()),
            StructField("over_limit", BooleanType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(tokenizer)
        for rows in text_chunks(batches, text_col):
            buf, offsets = flat(rows[text_col])
            n = model.count(buf, offsets)
            out = [rows[id_col].combine_chunks(), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)]
            yield from pa.table(out, names=schema.names).to_batches()

    return docs.select(id_col, text_col).mapInArrow(count, schema)
