"""Packing by powers of two: each document is cut into pieces of binary length, equal lengths share a bucket.

A document of n ids gives n // max_len pieces of `max_len` and one piece per set bit of the rest, longest
first. A piece is a sequence of its own: no sequence crosses documents and none is padded.
"""

from __future__ import annotations

import zlib

from pyspark import TaskContext
from pyspark.sql import DataFrame

from fareway.llm.common import id_text, map_batches, per_worker
from fareway.llm.tokens import Encoder, vocabulary_path

SCHEMA = (
    "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def binary_lengths(n: int, max_len: int) -> list[int]:
    """Lengths of the pieces of n ids; `max_len` must be a power of two."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << k for k in range(max_len.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack_powers(
    docs: DataFrame, *, vocabulary: str = "", max_len: int = 2048, end_id: int = 1, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: its ids, their place in the document, and the sequence that holds it.

    Without `keep_ids` there is no `ids` column, and the ids need not travel out of the task that made them.

    A NULL or empty text is the end id alone: one piece of length 1. Repeated rows are packed each.
    A NULL id stays NULL. Other columns are ignored. An empty table gives an empty result.
    `sequence_id` holds the task's number above bit 36, so it is unique without a second pass.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    path = vocabulary or vocabulary_path("byte_bpe_50k.json")
    end = end_id.to_bytes(4, "little")
    schema = SCHEMA if keep_ids else SCHEMA.replace("ids binary, ", "")

    def make():
        encoder, state = per_worker("encoder", path, lambda: Encoder(path)), [TaskContext.get().partitionId() << 36]

        def work(batch):
            rows = []
            for doc_id, ids in zip(batch["doc_id"], encoder.encode(batch["text"]), strict=True):
                ids += end
                n, start = len(ids) // 4, 0
                for length in binary_lengths(n, max_len):
                    piece = ids[4 * start : 4 * (start + length)]
                    own = (piece,) if keep_ids else ()
                    rows.append((doc_id, start, length, *own, zlib.crc32(piece), n, state[0], 0))
                    start += length
                    state[0] += 1
            yield dict(zip((x.split()[0] for x in schema.split(", ")), zip(*rows, strict=True), strict=True))

        return work

    return map_batches(id_text(docs, id_col, text_col), make, schema)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the pieces as Parquet, one folder per length."""
    pieces.write.mode("overwrite").partitionBy("length").parquet(path)
