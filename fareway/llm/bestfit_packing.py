"""Best-fit-decreasing packing of token ids into rows of fixed length.

Documents are packed in shards of a bounded number of ids, inside the task that read them. A document
longer than a row is cut at multiples of the row length, so joining its segments by start gives it back.
Segments are placed longest first, each into the fullest row that still has room; a segment tree over
the capacities finds that row.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fareway.llm.common import id_text, map_batches, per_worker
from fareway.llm.tokens import Encoder, vocabulary_path

SCHEMA = (
    "row_id long, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, position_resets array<int>, "
    "n_ids int, ids binary"
)
SHARD_IDS = 4_000_000


class CapacityTree:
    """Rows by free room; `take(n)` gives the row with the least room of at least n, or None."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        at = room + self.leaves
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def take(self, n: int) -> tuple[int, int] | None:
        at = n + self.leaves
        if not self.any[at]:
            while at > 1 and (at & 1 or not self.any[at + 1]):  # up to the first filled neighbour on the right
                at >>= 1
            if at == 1:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.any[at] = 0
            while at > 1:
                at >>= 1
                self.any[at] = self.any[2 * at] | self.any[2 * at + 1]
        return row, room


def best_fit(lengths: list[int], row_len: int) -> list[list[int]]:
    """Indices of the segments of each row, in the order in which they were placed."""
    tree, rows = CapacityTree(row_len), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        if (found := tree.take(n)) is None:
            found = len(rows), row_len
            rows.append([])
        row, room = found
        rows[row].append(i)
        if room > n:
            tree.put(row, room - n)
    return rows


def pack_best_fit(
    docs: DataFrame, *, vocabulary: str = "", row_len: int = 2048, end_id: int = 50256, pad_id: int = 50256,
    shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row of the id matrix per output row.

    `ids` are `row_len` little-endian unsigned 16-bit ids (32-bit for a vocabulary above 65,536), padded with
    `pad_id`; the first `n_ids` are real. Segment k lies in [cu_seqlens[k], cu_seqlens[k+1]); positions
    restart at `position_resets`. `doc_ids` and `starts` name each segment's document and its place there.
    A NULL or empty text is the end id alone. Repeated rows are packed each; a NULL id stays NULL; other
    columns are ignored; an empty table gives no rows.
    """
    path = vocabulary or vocabulary_path("byte_bpe_50k.json")

    def make():
        encoder = per_worker("encoder", path, lambda: Encoder(path))
        wide = "<u2" if max(encoder.tokenizer.get_vocab_size(), end_id + 1, pad_id + 1) <= 65536 else "<u4"
        end = np.array([end_id], "<u4").tobytes()
        held, count, state = [], [0], [TaskContext.get().partitionId() << 36]

        def flush():
            segments = [
                (doc_id, at, ids[at : at + row_len]) for doc_id, ids in held for at in range(0, len(ids), row_len)
            ]
            held.clear()
            count[0] = 0
            out = {name: [] for name in ("row_id", "doc_ids", "starts", "cu_seqlens", "position_resets", "n_ids", "ids")}
            for row in best_fit([len(x[2]) for x in segments], row_len):
                matrix_row, edges, at = np.full(row_len, pad_id, wide), [0], 0
                for i in row:
                    ids = segments[i][2]
                    matrix_row[at : at + len(ids)] = ids
                    at += len(ids)
                    edges.append(at)
                values = (
                    state[0], [segments[i][0] for i in row], [segments[i][1] for i in row], edges, edges[:-1], at, matrix_row.tobytes()
                )
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
                state[0] += 1
            return out

        def work(batch):
            for doc_id, ids in zip(batch["doc_id"], encoder.encode(batch["text"]), strict=True):
                held.append((doc_id, np.frombuffer(ids + end, "<u4").astype(wide)))
                count[0] += len(held[-1][1])
                if count[0] >= shard_ids:
                    yield flush()

        work.rest = lambda: [flush()] if held else []
        return work

    return map_batches(id_text(docs, id_col, text_col), make, SCHEMA)
