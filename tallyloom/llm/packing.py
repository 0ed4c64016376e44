"""Best-fit-decreasing packing of token pieces into sequences of a fixed capacity.

Pieces of one length are interchangeable, and so are open sequences of one remaining capacity. The packing of the
whole corpus is therefore fixed by how many pieces there are of each length: at most ``capacity`` counts, whatever the
corpus holds. The plan is made from those counts alone: lengths in falling order, each time the tightest open capacity found in
a segment tree. It says for each run of ranks within a length which run of sequences takes it. Every piece then finds its place
from its length and its rank among the pieces of that length, which tasks count for themselves and then shift by the counts of
the tasks before them.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.encoder import END_ID, encoder
from tallyloom.llm.words import text_slices
from tallyloom.session import park

CAPACITY = 2048


class CapacityTree:
    """How many sequences are open at each remaining capacity; finds the tightest that fits in log time."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, remaining: int, count: int) -> None:
        at = remaining + self.leaves
        while at:
            self.counts[at] += count
            at >>= 1

    def open_at(self, remaining: int) -> int:
        return self.counts[remaining + self.leaves]

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of at least ``length`` at which a sequence is open."""
        at = length + self.leaves
        if self.counts[at]:
            return length
        while at > 1:  # up until a right sibling holds something, then down its left edge
            if at % 2 == 0 and self.counts[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.counts[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, pieces, first sequence, offset) that place every piece by best fit, longest first.

    Ranks ``first .. first + pieces - 1`` go to as many sequences in a row, all at the same offset. A sequence that took a piece
    is then the tightest for the next as long as it fits, so each is filled as deep as it goes.
    """
    tree = CapacityTree(capacity)
    runs: dict[int, deque] = defaultdict(deque)  # by remaining capacity: (first sequence, sequences)
    rows, sequences = [], 0

    def open_run(remaining: int, first: int, count: int) -> None:
        if remaining:
            runs[remaining].append((first, count))
            tree.add(remaining, count)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens; the capacity is {capacity}")
        while left:
            remaining = tree.tightest(length)
            if remaining is None:  # a new sequence for each, as many pieces in it as fit
                deep = min(capacity // length, left)
                wide = left // deep
                for level in range(deep):
                    rows.append((length, rank, wide, sequences, level * length))
                    rank += wide
                left -= deep * wide
                open_run(capacity - deep * length, sequences, wide)
                sequences += wide
                continue
            first, count = runs[remaining].popleft()
            deep = min(remaining // length, left)
            wide = min(count, left // deep)
            if wide < count:
                runs[remaining].appendleft((first + wide, count - wide))
            tree.add(remaining, -wide)
            for level in range(deep):
                rows.append((length, rank, wide, first, capacity - remaining + level * length))
                rank += wide
            left -= deep * wide
            open_run(remaining - deep * length, first, wide)
    return rows


def cut_points(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one if it fits, else full ones behind a shorter first piece."""
    if n_ids <= capacity:
        return [(0, n_ids)]
    head = n_ids % capacity
    starts = [0] if head else []
    starts += range(head, n_ids, capacity)
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_ids])]


def encode_pieces(
    docs: DataFrame, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text",
    path: str | None = None, end_id: int | None = END_ID, keep_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, task_rank[, ids]) of every document's pieces, stored.

    ``task_rank`` counts the pieces of one length within the task that wrote them. Eager: one pass over the texts.
    """
    rows = docs.select(id_column, text_column)
    kind = rows.schema[0].dataType.simpleString()
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def cut(batches):
        enc, task, seen = encoder(path), TaskContext.get().partitionId(), defaultdict(int)
        for part in text_slices(batches, 1):
            owner, out = [], []
            for at, ids in enumerate(enc.encode_rows(part.column(1), tail)):
                for piece, (first, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                    if not length:
                        continue
                    own = ids[4 * first : 4 * (first + length)]
                    owner.append(at)
                    out.append((piece, first, length, zlib.crc32(own), task, seen[length], own))
                    seen[length] += 1
            here = part.column(0).take(pa.array(owner, pa.int64()))
            columns = list(zip(*out)) or [()] * 7
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            arrays = [here, *(pa.array(c, t) for c, t in zip(columns, types))]
            yield pa.RecordBatch.from_arrays(arrays if keep_ids else arrays[:-1], names)

    names = [id_column, "piece", "start", "length", "ids_crc32", "task", "task_rank", "ids"][: 8 if keep_ids else 7]
    schema = f"{id_column} {kind}, piece int, start long, length long, ids_crc32 long, task int, task_rank long"
    return park(rows.mapInArrow(cut, schema + (", ids binary" if keep_ids else "")), "pieces")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset: best-fit decreasing over all of them at once.

    Only the counts by length, at most ``capacity`` of them, come to the driver.
    """
    if capacity >= 1 << 15:
        raise ValueError("capacities of 32768 tokens and more are not supported")
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = park(per_task.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))), "shifts")
    counts = {r["length"]: r["n"] for r in shifts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = sorted(plan_packing(counts, capacity))  # by length, then by first rank
    lengths, ranks, _, sequences, offsets = np.array(plan, dtype=np.int64).reshape(-1, 5).T
    keys = _place_keys(lengths, ranks)

    def assign(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (batch.num_columns - 2, batch.num_columns - 1))
            row = np.searchsorted(keys, _place_keys(length, rank), side="right") - 1
            found = [pa.array(sequences[row] + rank - ranks[row], pa.int64()), pa.array(offsets[row], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *found], schema.names)

    kept = [c for c in pieces.columns if c not in ("task", "task_rank", "sequence_id", "offset")]
    ranked = pieces.join(shifts.select("task", "length", "shift"), ["task", "length"]).select(
        *kept, F.col("length").alias("length_key"), (F.col("task_rank") + F.col("shift")).alias("rank")
    )
    schema = ranked.select(*kept, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    return ranked.mapInArrow(assign, schema)


def _place_keys(lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """One number that orders (length, rank): lengths below 2 to the power of 15, ranks below that of 48."""
    return lengths.astype(np.int64) << 48 | ranks.astype(np.int64)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **encoding) -> DataFrame:
    """Every document cut into pieces of at most ``capacity`` tokens and packed into as few sequences as best fit gives.

    Null and empty texts hold the end id alone; null and repeated ids are rows like others; columns other than id
    and text are not read. An empty table gives no rows. Options as in ``encode_pieces``; eager.
    """
    return place(encode_pieces(docs, capacity, **encoding), capacity)
