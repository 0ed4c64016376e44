"""Removing passages that stand more than once, found from anchors: fixed blocks of words probed by rolling windows.

A text is cut into reference blocks of ``block`` words that do not overlap. A window of ``window`` words holds a whole block wherever it
starts, as long as 2 * block - 1 <= window. So of two equal windows each holds a block of its own text, and the same words stand in the
other window too, at any offset. Hence two meetings, both by ranges of a rolling hash:

1. every text sends the hashes of its rolling windows of ``block`` words, marked where they are reference blocks. A hash that
   is a block somewhere and stands twice or more goes back to its texts as an anchor;
2. anchors extend to whole windows: texts that hold some send the hashes of just the windows around them. What stands
   twice goes back, and the union of these windows, which makes up the maximal exact repeats, is removed.

A task sends a hash once for all its texts, marked if several places hold it; its other texts know at once that they hold an anchor.
So a passage that a third of all texts share costs a row a task. Texts are named by a 128-bit hash, and texts without any anchor, as far as a bitmap of bounded
size tells, are not shuffled. Windows are equal if two rolling hashes of 64 bits agree in the range and 62 further bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import bitmap
from tallyloom.llm.words import Words, byte_kinds, text_buffers, text_slices
from tallyloom.session import park

KINDS = byte_kinds(b" \t\n\x0b\x0c\r")
WINDOW = 35
HASHES_A_PART = 1_500_000
SLICE_BYTES = 2_000_000
_FACTORS = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]  # odd
_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]
_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

ANCHOR, SEVERAL = np.uint64(1), np.uint64(2)
MEETING = "part int, slice long, owners binary, hashes binary, keys binary"
MEETING_NAMES = ["part", "slice", "owners", "hashes", "keys"]


def _powers(factor: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 to the power of 64."""
    most = 1 << max(16, (size - 1).bit_length())
    if (factor, most) not in _POWERS:
        both = []
        for f in (factor, pow(factor, -1, 1 << 64)):
            steps = np.full(most, f, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[factor, most] = (both[0], both[1])
    up, down = _POWERS[factor, most]
    return up[:size], down[:size]


def rolling(words: np.ndarray, window: int, factor: int) -> np.ndarray:
    """A hash for each run of ``window`` words, from the words' hashes."""
    if len(words) < window:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(factor, len(words) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * down[:-1], dtype=np.uint64)])
    out = (sums[window:] - sums[:-window]) * up[: len(words) - window + 1]
    out = (out ^ (out >> np.uint64(30))) * _MIX[0]
    out = (out ^ (out >> np.uint64(27))) * _MIX[1]
    return out ^ (out >> np.uint64(31))


class Texts:
    """Some texts as words with rolling hashes."""

    def __init__(self, column: pa.Array):
        self.raw, self.bounds = text_buffers(column)
        self.words = Words(self.raw, self.bounds, KINDS)
        distinct = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words.distinct), np.uint64, len(self.words.distinct))
        self.hashes = distinct[self.words.codes]
        self.sizes = np.diff(self.words.of_text)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, text) of every run of ``size`` words within a text."""
        per_text = np.maximum(self.sizes - size + 1, 0)
        text = np.repeat(np.arange(len(per_text)), per_text)
        before = np.cumsum(per_text) - per_text
        return self.words.of_text[:-1][text] + np.arange(len(text)) - before[text], text

    def kept_digests(self, removed: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """(removed words, digest of the kept words joined by spaces) of each text."""
        bounds = self.words.of_text
        gone = np.concatenate([[0], np.cumsum(removed)])[bounds]
        keep = np.flatnonzero(~removed)
        lengths = self.words.lengths[keep] + 1
        ends = np.cumsum(lengths)
        # The kept words' bytes, each followed by a space, gathered in one go.
        source = np.repeat(self.words.starts[keep] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        source[ends - 1] = 0
        out = self.raw[source]
        out[ends - 1] = 32
        spelled, at = out.tobytes(), np.concatenate([[0], ends])[np.searchsorted(keep, bounds)]
        return np.diff(gone), [hashlib.sha256(spelled[a : max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def text_key(column: str) -> Column:
    """A 128-bit name of a text; null texts are empty."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.concat(F.unhex(F.lpad(F.hex(F.xxhash64(text)), 16, "0")), F.unhex(F.lpad(F.hex(F.xxhash64(F.lit(1), text)), 16, "0")))


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _spans(heads: np.ndarray, size: int) -> list[tuple[int, int]]:
    bounds = [*heads.tolist(), size]
    return list(zip(bounds[:-1], bounds[1:]))


def _owners(numbers: np.ndarray) -> bytes:
    """Ascending numbers as steps, low bytes before high ones, which compresses well."""
    return np.diff(numbers, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").reshape(-1), dtype=np.int64)


def _rows(part: np.ndarray, part_slice: np.ndarray | int, owner: np.ndarray, hashes: np.ndarray) -> list[tuple]:
    """(part, slice, owners, hashes, null) for each run of (part, slice); the owners of a run ascend."""
    slices = part_slice if isinstance(part_slice, np.ndarray) else np.full(len(part), part_slice)
    spans = _spans(_heads(part, slices), len(part))
    return [(int(part[a]), int(slices[a]), _owners(owner[a:b]), hashes[a:b].tobytes(), None) for a, b in spans]


def _batch(rows: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*rows)) or [()] * 5
    return [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))]


def _send(slice_id: int, hashes: np.ndarray, part: np.ndarray, anchor: np.ndarray, text: np.ndarray, keys: np.ndarray, parts: int, kind) -> pa.RecordBatch:
    """What one slice of texts sends: each hash once, with its marks, and by a part of the slice's own, which only hands them on,
    the names of its texts and what else they hold of hashes met several times.

    Hashes have two low bits free for the marks. ``text`` numbers the ``keys``; equal texts have one number.
    """
    order = np.argsort(part.astype(np.uint64) << np.uint64(32) | hashes if kind is np.uint32 else hashes)
    part, hashes, anchor, text = part[order], hashes[order], anchor[order], text[order]
    heads = _heads(hashes, part)
    own = parts + slice_id % parts
    rows = [(own, slice_id, None, None, keys.tobytes())]
    if len(heads):
        runs = np.diff(np.append(heads, len(hashes)))
        marks = np.where(runs > 1, SEVERAL, np.uint64(0)) | np.where(np.logical_or.reduceat(anchor, heads), ANCHOR, np.uint64(0))
        first = np.minimum.reduceat(text, heads)
        other = np.flatnonzero(text != np.repeat(first, runs))
        order = np.lexsort((hashes[other], text[other]))
        other = other[order]
        other = other[_heads(text[other], hashes[other])]
        rows += _rows(np.full(len(other), own), slice_id, text[other], hashes[other].astype(kind))
        order = np.argsort(part[heads] << 32 | first)
        rows += _rows(part[heads][order], slice_id, first[order], (hashes[heads] | marks)[order].astype(kind))
    return pa.RecordBatch.from_arrays(_batch(rows), MEETING_NAMES)


def _answer(parts: int, kind):
    """Of a part, what stands twice or more and is an anchor, by slice; of parts beyond, everything."""

    def merge(table: pa.Table) -> pa.Table:
        if table["part"][0].as_py() >= parts:
            return table
        part, names = table["part"][0].as_py(), table["slice"].to_numpy()
        owners = [_numbers(x).astype(np.uint32) for x in table["owners"].to_pylist()]
        row = np.repeat(np.arange(len(owners), dtype=np.uint32), [len(x) for x in owners])
        owner, hashes = np.concatenate(owners), np.frombuffer(b"".join(table["hashes"].to_pylist()), dtype=kind)
        del table, owners
        order = np.argsort(hashes)  # the marks are the low bits, so equal hashes lie together
        plain = hashes[order] & ~kind(3)
        heads = _heads(plain)
        runs = np.diff(np.append(heads, len(plain)))
        met = np.bitwise_or.reduceat(hashes[order] & kind(3), heads)
        good = order[np.repeat(((met & kind(ANCHOR)) > 0) & ((runs > 1) | ((met & kind(SEVERAL)) > 0)), runs)]
        del order, plain
        good = good[np.lexsort((owner[good], names[row[good]]))]
        rows = _rows(np.full(len(good), part), names[row[good]], owner[good], hashes[good] & ~kind(3))
        return pa.Table.from_arrays(_batch(rows), MEETING_NAMES)

    return merge


def _by_text(kind):
    """(key, found): the hashes that came back to a slice, by text."""

    def resolve(table: pa.Table) -> pa.Table:
        names, owners, hashes = (table[c].to_pylist() for c in ("keys", "owners", "hashes"))
        keys = np.frombuffer(next(k for k in names if k is not None), dtype="V16")
        owner = np.concatenate([np.zeros(0, np.int64), *(_numbers(x) for x in owners if x is not None)])
        found = np.frombuffer(b"".join(x for x in hashes if x is not None), dtype=kind)
        order = np.argsort(owner, kind="stable")
        owner, found = owner[order], found[order]
        spans = _spans(_heads(owner), len(owner))
        return pa.table(
            {
                "key": pa.array([keys[owner[a]].tobytes() for a, _ in spans], pa.binary()),
                "found": pa.array([found[a:b].tobytes() for a, b in spans], pa.binary()),
            }
        )

    return resolve


def _returned(rows: DataFrame, parts: int, kind) -> DataFrame:
    """(key, found): for every text the hashes that matter to it. Equal texts in several slices get the same; one is taken."""
    back = rows.groupBy("part").applyInArrow(_answer(parts, kind), MEETING).groupBy("slice").applyInArrow(_by_text(kind), "key binary, found binary")
    return back.groupBy("key").agg(F.first("found").alias("found"))


def _split_hash(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _named(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys of a column, number of the key of each row)."""
    halves = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, 2)
    distinct, number = np.unique(halves, axis=0, return_inverse=True)
    return distinct, number.reshape(-1)


def _probe_hash(hashes: np.ndarray) -> np.ndarray:
    """30 bits of a hash beside its part, with two low bits free."""
    return (hashes & np.uint64(0xFFFFFFFF)) & ~np.uint64(3)


def _window_hashes(texts: Texts, window: int, start: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(62 bits with two low ones free, part) of the windows that begin at ``start``, from two independent hashes."""
    one, two = (rolling(texts.hashes, window, f)[start] for f in _FACTORS)
    return one & ~np.uint64(3), _split_hash(two, parts)


def _listed(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a column of binaries, and the row of each; nulls hold none."""
    found = [x or b"" for x in column.to_pylist()]
    sizes = np.array([len(x) for x in found], dtype=np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(found), dtype=kind), np.repeat(np.arange(len(found)), sizes)


def _slices(batches, column: int):
    """(number, rows): slices of texts with a number that no other task's slices have."""
    task = TaskContext.get().partitionId()
    for n, batch in enumerate(text_slices(batches, column, SLICE_BYTES)):
        yield task << 32 | n, batch


def _member(text: np.ndarray, hashes: np.ndarray, of_text: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which (text, hash) stand among those found."""
    mine, theirs = np.empty(len(text), dtype="u8,u8"), np.empty(len(found), dtype="u8,u8")
    mine["f0"], mine["f1"], theirs["f0"], theirs["f1"] = text, hashes, of_text, found
    hit = np.isin(hashes, found)  # cheap; few pass
    at = np.flatnonzero(hit)
    hit[at] = np.isin(mine[at], theirs)
    return hit


def _covered(starts: np.ndarray, size: int, words: int) -> np.ndarray:
    """Which of ``words`` words lie in a window of ``size`` words that begins at one of ``starts``."""
    edges = np.zeros(words + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + size, words), -1)
    return np.cumsum(edges[:-1]) > 0


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row: words in a window of ``window`` words that also starts elsewhere go.

    Elsewhere is any other place of any row, its own included; windows are judged on the input. Words are runs of bytes other
    than ASCII white space, unchanged. Null and empty texts have no words, texts of fewer words than a window lose none; equal
    rows are repeats of each other; null and repeated ids are rows like others; other columns are not read; an
    empty table gives no rows. Eager: anchors and repeated windows are parked.
    """
    if window < 1:
        raise ValueError("a window has a word at least")
    block, spark = (window + 1) // 2, docs.sparkSession
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text")).withColumn("key", text_key("text"))
    in_all = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), in_all // (6 * HASHES_A_PART) + 1)

    def probe(batches):
        for slice_id, batch in _slices(batches, 1):
            texts, (keys, number) = Texts(batch.column(1)), _named(batch.column(2))
            first, text = texts.windows(block)
            hashes = rolling(texts.hashes, block, _FACTORS[0])[first]
            anchor = (first - texts.words.of_text[:-1][text]) % block == 0
            yield _send(slice_id, _probe_hash(hashes), _split_hash(hashes, parts), anchor, number[text], keys, parts, np.uint32)

    anchors = park(_returned(rows.mapInArrow(probe, MEETING), parts, np.uint32), "anchors")
    first_half = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")
    held = spark.sparkContext.broadcast(bitmap.build(anchors.select(first_half.alias("hash")), "hash", anchors.count()))

    def may_hold(batches):
        for batch in batches:
            names = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=">u8")[::2].astype(np.uint64)
            yield batch.append_column("held", pa.array(bitmap.holds(held.value, names)))

    marked = rows.mapInArrow(may_hold, rows.withColumn("held", F.lit(True)).schema)
    anchored = park(marked.where("held").drop("held").join(anchors, "key", "left").select(id_column, "text", "key", "found"), "anchored")

    def extend(batches):
        for slice_id, batch in _slices(batches, 0):
            texts, (keys, number) = Texts(batch.column(0)), _named(batch.column(1))
            found, owner = _listed(batch.column(2), np.uint32)
            first, text = texts.windows(block)
            hit = _member(text, _probe_hash(rolling(texts.hashes, block, _FACTORS[0])[first]), owner, found)
            # A window holds an anchor if one begins within its first window - block + 1 words.
            begins = np.concatenate([[0], np.cumsum(np.bincount(first[hit], minlength=len(texts.hashes)))])
            start, text = texts.windows(window)
            near = begins[start + window - block + 1] > begins[start]
            start, text = start[near], text[near]
            hashes, part = _window_hashes(texts, window, start, parts)
            yield _send(slice_id, hashes, part, np.ones(len(hashes), bool), number[text], keys, parts, np.uint64)

    sent = anchored.select("text", "key", "found").mapInArrow(extend, MEETING)
    windows = park(_returned(sent, parts, np.uint64), "windows")
    kind = rows.schema[0].dataType.simpleString()
    schema = f"{id_column} {kind}, n_words long, n_removed long, kept_sha256 string"

    def settle(batches):
        for batch in text_slices(batches, 1, SLICE_BYTES):
            texts = Texts(batch.column(1))
            removed = np.zeros(len(texts.hashes), dtype=bool)
            if batch.num_columns > 2:
                found, owner = _listed(batch.column(2), np.uint64)
                start, text = texts.windows(window)
                hashes, _ = _window_hashes(texts, window, start, parts)
                removed = _covered(start[_member(text, hashes, owner, found)], window, len(removed))
            gone, digests = texts.kept_digests(removed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts.sizes), pa.array(gone), pa.array(digests, pa.string())],
                [id_column, "n_words", "n_removed", "kept_sha256"],
            )

    clean = marked.where(~F.col("held")).select(id_column, "text").mapInArrow(settle, schema)
    mixed = anchored.drop("found").join(windows, "key", "left").select(id_column, "text", "found")
    return clean.unionByName(mixed.mapInArrow(settle, schema))
