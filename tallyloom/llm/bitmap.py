"""Bitmaps of bounded size over 64-bit hashes: a member is always found, a stranger now and then.

They only thin out work that an exact count or join repeats, so a full bitmap costs time and no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 27
PAGE_BYTES = 4096
BITS_PER_MEMBER = 16


def bit_count(members: int) -> int:
    """A power of two, some bits for each member, between one page and MOST_BITS."""
    bits = 8 * PAGE_BYTES
    while bits < BITS_PER_MEMBER * members and bits < MOST_BITS:
        bits *= 2
    return bits


def build(hashes: DataFrame, column: str, members: int) -> bytes:
    """The bitmap of a long column of hashes. What comes to the driver are its pages, at most MOST_BITS in all."""
    bits = bit_count(members)
    place = F.shiftrightunsigned(F.col(column), 64 - bits.bit_length() + 1).alias("place")
    cells = hashes.where(F.col(column).isNotNull()).select(place).selectExpr("place >> 6 AS cell", "shiftleft(1L, int(place & 63)) AS bit")
    cells = cells.groupBy("cell").agg(F.bit_or("bit").alias("bit")).withColumn("page", F.expr(f"cell div {PAGE_BYTES // 8}"))

    def page_of(table: pa.Table) -> pa.Table:
        page = np.zeros(PAGE_BYTES // 8, dtype=np.int64)
        page[table["cell"].to_numpy() % len(page)] = table["bit"].to_numpy()
        return pa.table({"page": pa.array(table["page"].to_numpy()[:1], pa.int64()), "bits": pa.array([page.tobytes()], pa.binary())})

    out = bytearray(bits // 8)
    for row in cells.groupBy("page").applyInArrow(page_of, "page long, bits binary").toLocalIterator():
        out[row["page"] * PAGE_BYTES : (row["page"] + 1) * PAGE_BYTES] = row["bits"]
    return bytes(out)


def holds(bitmap: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit hashes may be members."""
    cells = np.frombuffer(bitmap, dtype=np.uint64)
    place = hashes >> np.uint64(64 - (8 * len(bitmap)).bit_length() + 1)
    return (cells[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
