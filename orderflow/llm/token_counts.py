"""Token counts: rank-synchronous merging of ragged arrays, counting the symbols that survive.

Spark cuts the texts into pre-tokens; a task holds a batch of their distinct words as one ragged
numpy array and merges every word's lowest-ranked pair at once, round after round.  A document's
count is the sum over its pre-tokens.  There is no shuffle, and memory is bounded by a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.bpe import Bpe, batches, pretokens, word_ids
from orderflow.llm.common import documents, row_sums


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row of ``docs``.

    ``tokenizer`` is the path of a byte-level BPE file.  Null and empty texts have no tokens; a null
    id stays null; repeated rows are counted each; further columns are ignored; an empty table gives
    an empty one.  Texts are never cut: a row longer than a slice makes a slice of its own.
    """
    bpe = Bpe.load(tokenizer)
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def count(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            for piece, words, word, rows in batches(table, "pre"):
                _, offsets = word_ids(shared.value, words)
                n = row_sums(np.diff(offsets)[word], rows)
                yield pa.record_batch([piece.column("doc_id"), piece.column("n_bytes"), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    cut = documents(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), pretokens(F.col("text"), bpe).alias("pre"))
    counts = cut.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
