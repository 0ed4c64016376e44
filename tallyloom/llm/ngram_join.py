"""Similarity self-join of documents on word shingles: all documents whose shingle sets reach a Jaccard threshold.

1. One pass over the texts gives each document its number of distinct shingles, a digest of the set and band keys. Equal sets
   become one class with a representative.
2. Band keys split the documents into units: documents that share a key, directly or through others, are one unit. A key hashes ``ROWS``
   minima of random orders; at the threshold t a linked pair misses all of its keys with a probability below
   ``MISS`` (1e-15, as rare as a clash of the 64-bit shingle hashes), so links stay within units.
3. Units are cut into blocks by size class and hash, and block meets block: each meeting builds signature trees over its sets and
   traverses them together. Links are decided on the whole sets. Each meeting returns only a star for each component that it found.
4. The stars' connected components, with the classes expanded, are the answer.

No group is held whole in a task: a unit of any size falls into blocks of at most ``BLOCK_DOCS`` documents on average.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import signature_tree
from tallyloom.llm.components import connected_components
from tallyloom.session import park

ROWS = 3
MISS = 1e-15
BLOCK_DOCS = 256
BLOCK_SHINGLES = 400_000
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of the text; A-Z in lower case, words between ASCII white space.

    Fewer words than ``words``: the whole sequence is one shingle. No words: none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), dtype=np.uint64, count=len(found))
    taken = min(words, len(hashes))
    count = len(hashes) - taken + 1
    mixed = np.full(count, taken, dtype=np.uint64)
    for i in range(taken):
        mixed = (mixed ^ hashes[i : i + count]) * _MIX[0]
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed ^ mixed >> np.uint64(33)) * _MIX[1]
    mixed = (mixed ^ mixed >> np.uint64(33)) * _MIX[2]
    return np.unique(mixed ^ mixed >> np.uint64(33))


def bands(percent: int) -> int:
    """Keys for each document so that a pair at the threshold shares one, but for a probability of ``MISS``."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS))) if percent < 100 else 1


@lru_cache
def _orders(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    draw = lambda: rng.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)[:, None]
    return draw(), draw() | np.uint32(1)


def band_keys(shingles: np.ndarray, number: int) -> np.ndarray:
    """One 64-bit key for each band: a hash of ``ROWS`` minima."""
    flips, factors = _orders(number * ROWS)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(number * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), 1024):
        least = np.minimum(least, ((short[None, at : at + 1024] ^ flips) * factors).min(axis=1))
    keys = np.arange(1, number + 1, dtype=np.uint64) * _MIX[2]
    for row in range(ROWS):
        keys = (keys ^ least[row::ROWS].astype(np.uint64)) * _MIX[0]
        keys ^= keys >> np.uint64(31)
    return (keys * _MIX[1]).view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sketches(docs: DataFrame, id_column: str, text_column: str, words: int, percent: int) -> DataFrame:
    number = bands(percent)

    def sketch(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                counts, digests, keys = [], [], []
                for value in some.column(1):
                    shingles = shingle_set(value.as_py(), words)
                    counts.append(len(shingles))
                    digests.append(_digest(shingles) if len(shingles) else None)
                    keys.append(band_keys(shingles, number) if len(shingles) else None)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "n", "digest", "keys"],
                )

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return park(rows.mapInArrow(sketch, "id long, n long, digest binary, keys array<long>"), "sketches")


def _units(classes: DataFrame) -> DataFrame:
    """(rep, unit, n, digest) of the classes that share a band key with another, directly or through others; stored."""
    keyed = classes.select("rep", F.explode("keys").alias("key"))
    first = park(
        keyed.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first <> last").select("key", "first"),
        "shared-keys",
    )
    touching = keyed.join(first, "key").where("rep <> first").select("rep", "first").distinct()
    units = connected_components(touching, "rep", "first")
    return park(classes.join(units, F.col("rep") == F.col("node")).select("rep", F.col("component").alias("unit"), "n", "digest"), "units")


def _meetings(units: DataFrame, percent: int, block_docs: int, block_shingles: int) -> DataFrame:
    """(rep, digest, meeting): every meeting of two blocks of a unit that a member takes part in.

    Sets that link differ in size by less than the threshold, so blocks meet within a size class and the next one only.
    """
    totals = F.greatest(F.count("*") / block_docs, F.sum("n") / block_shingles)
    whole = park(units.groupBy("unit").agg(totals.alias("load")), "unit-loads")
    step = (math.log(100 / percent) if percent < 100 else 0.01) * (1 + 1e-9)  # a hair wider than the threshold's ratio
    size_class = F.when(F.col("load") <= 1, 0).otherwise(F.floor(F.log("n") / step)).cast("int")
    members = park(units.join(whole, "unit").select("rep", "unit", "n", "digest", size_class.alias("size")), "members")
    blocks = members.groupBy("unit", "size").agg(F.ceil(totals).cast("int").alias("blocks"))
    tables = park(blocks.groupBy("unit").agg(F.map_from_entries(F.collect_list(F.struct("size", "blocks"))).alias("blocks")), "blocks")
    named = lambda a, i, b, j: F.concat_ws(".", a, i, b, j)
    count = lambda size: F.coalesce(F.try_element_at("blocks", size), F.lit(0))
    numbers = lambda size: F.when(count(size) > 0, F.sequence(F.lit(0), count(size) - 1)).otherwise(F.array().cast("array<int>"))
    size, own = F.col("size"), F.col("block")
    meetings = F.concat(
        F.transform(numbers(size), lambda j: named(size, F.least(own, j), size, F.greatest(own, j))),
        F.transform(numbers(size + 1), lambda j: named(size, own, size + 1, j)),
        F.transform(numbers(size - 1), lambda j: named(size - 1, j, size, own)),
    )
    return (
        members.join(tables, "unit")
        .withColumn("block", F.pmod(F.xxhash64("rep"), count(size)).cast("int"))
        .select("rep", "digest", "unit", F.concat_ws(".", "size", "block").alias("side"), meetings.alias("meetings"))
    )


def jaccard_classes(docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text",
                    block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(id, n_shingles, component_id) of every row: documents link at 100 * intersection >= ``percent`` * union.

    component_id is the smallest id reachable by links, the document's own included. Null texts and texts without words have no shingles
    and link with nothing, and neither do rows with a null id (component null). Equal texts link whatever their length. Rows that repeat an id
    and its text are one document; ids are taken to name one text. Other columns are not read. Eager.
    """
    if not 50 <= percent <= 100:
        raise ValueError("thresholds from 50 to 100 percent")
    sketches = _sketches(docs, id_column, text_column, words, percent)
    with_set = sketches.where("n > 0 and id is not null")
    classes = park(
        with_set.groupBy("digest").agg(F.min("id").alias("rep"), F.any_value("n").alias("n"), F.any_value("keys").alias("keys")), "classes"
    )
    members = _meetings(_units(classes), percent, block_docs, block_shingles)
    texts = docs.select(F.col(id_column).cast("long").alias("rep"), F.col(text_column).alias("text"))

    def meet(key, rows):
        found: dict[str, tuple[list, list]] = {}
        taken = set()
        for rep, digest, side, text in zip(*(rows.column(c).to_pylist() for c in ("rep", "digest", "side", "text"))):
            shingles = shingle_set(text, words)
            if rep not in taken and _digest(shingles) == digest:  # a repeated row counts once
                taken.add(rep)
                reps, sets = found.setdefault(side, ([], []))
                reps.append(rep)
                sets.append(shingles)
        names = sorted(found)
        reps = [rep for name in names for rep in found[name][0]]
        components = signature_tree.Components(len(reps))
        largest = max((len(s) for name in names for s in found[name][1]), default=1)
        width, trees, first = signature_tree.bitmap_words(largest), [], 0
        for name in names:
            trees.append(signature_tree.SignatureTree(found[name][1], width, first))
            first += len(found[name][0])
        if len(trees) == 1:
            signature_tree.join(trees[0], trees[0], percent, components)
        elif trees:
            signature_tree.join(trees[0], trees[1], percent, components)
        roots = components.roots()
        reps_array = np.array(reps, dtype=np.int64)
        linked = roots != np.arange(len(roots))
        return pa.table({"a": reps_array[linked], "b": reps_array[roots[linked]]})

    dealt = (
        members.join(texts, "rep")
        .select("rep", "digest", "unit", "side", "text", F.explode("meetings").alias("meeting"))
        .groupBy("unit", "meeting")
        .applyInArrow(meet, "a long, b long")
    )
    components = connected_components(dealt)
    placed = park(
        classes.select("digest", "rep").join(components, F.col("rep") == F.col("node"), "left").select("digest", F.coalesce("component", "rep").alias("component")),
        "placed",
    )
    return sketches.select("id", "n", "digest").join(placed, "digest", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )
