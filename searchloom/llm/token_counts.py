"""Tokens per document, without its ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from searchloom.llm.blocks import blocks
from searchloom.llm.tables import id_text
from searchloom.llm.tokens import tokenizer

CONTEXT = 2048


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int = CONTEXT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, one row per row of ``docs``.

    Each distinct pre-token of a block is counted once, its count is joined to the
    frequencies of the block's documents and summed.  A worker keeps the counts it
    has met, two million at most.  There is no shuffle: hot sources and copies
    cost what their bytes cost.

    Null and empty texts have 0 bytes and 0 tokens.  Ids may repeat or be null;
    every row is counted by itself.  Columns other than the two are not read.
    """

    def count(batches):
        tokens = tokenizer(path)
        for batch in batches:
            texts = batch.column(1)
            n_bytes, n_tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for block in blocks(texts):
                n_bytes.append(np.diff(block.offsets))
                n_tokens.append(tokens.count(block))
            total = np.concatenate(n_tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.concatenate(n_bytes), pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(total > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return id_text(docs, id_col, text_col).mapInArrow(count, schema)
