"""Token ids in raw binary files with a minimal perfect hash index for keyed access.

One file holds one shard: documents in ascending key order, their ids as raw little-endian payload, and an index.

    magic 8 | header 6 x int64: documents, ids, bytes per id, buckets, seed, first row of the shard
    keys int64 x documents (file order) | null flags uint8 x documents | occurrence int32 x documents
    offsets int64 x (documents + 1), in ids | bucket displacements uint32 x buckets
    slot fingerprints uint32 x documents | slot ranks int32 x documents | payload | trailer 8

A key is hashed to a bucket; the bucket's displacement sends every key of the shard to a slot of its own,
with no slot left over. The slot holds a fingerprint, which turns away nearly all foreign keys before the stored key
is compared, and the document's rank in the file, which gives its offset. All in constant time.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.encoder import END_ID, encoder, load_tokenizer, vocabulary_path
from tallyloom.llm.words import text_slices
from tallyloom.session import park

MAGIC, TRAILER = b"TLTOKEN1", b"TLTOKEND"
SHARD_IDS = 4_000_000
KEYS_PER_BUCKET = 4
PAGE = 4096
_HEADER = struct.Struct("<6q")
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def key_hashes(keys: np.ndarray, nulls: np.ndarray, occurrences: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of (key, null or not, which of the rows with that key)."""
    base = keys.astype(np.int64).view(np.uint64) * _MIX[0] + np.uint64(seed)
    return _mix(_mix(base) + occurrences.astype(np.uint64) * np.uint64(2) + nulls.astype(np.uint64))


def _slots(hashes: np.ndarray, displacement: np.ndarray, size: int) -> np.ndarray:
    return (_mix(hashes + displacement.astype(np.uint64) * _MIX[0]) % np.uint64(size)).astype(np.int64)


def build_index(keys: np.ndarray, nulls: np.ndarray, occurrences: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacements by bucket, slot by key) of a minimal perfect hash; keys must differ."""
    size = len(keys)
    buckets = max(1, -(-size // KEYS_PER_BUCKET))
    for seed in range(1, 100):
        hashes = key_hashes(keys, nulls, occurrences, seed)
        if len(np.unique(hashes)) < size:
            continue
        bucket = (hashes >> np.uint64(32)).astype(np.int64) % buckets
        by_bucket = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
        displacements = np.zeros(buckets, dtype=np.uint32)
        slots = np.full(size, -1, dtype=np.int64)
        taken = np.zeros(size, dtype=bool)
        free = size
        for b in np.argsort(-(starts[1:] - starts[:-1]), kind="stable").tolist():  # the fullest first
            members = by_bucket[starts[b] : starts[b + 1]]
            if not len(members):
                break
            step, found = 256 if len(members) > 1 else max(256, 4 * size // free), None
            for first in range(0, 1 << 24, step):
                tries = np.arange(first, first + step, dtype=np.uint64)
                at = (_mix(hashes[members][None, :] + tries[:, None] * _MIX[0]) % np.uint64(size)).astype(np.int64)
                good = ~taken[at].any(axis=1)
                if len(members) > 1:
                    good &= (np.diff(np.sort(at, axis=1), axis=1) > 0).all(axis=1)
                if good.any():
                    found = int(np.argmax(good))
                    break
            if found is None:
                break
            displacements[b] = first + found
            slots[members] = at[found]
            taken[at[found]] = True
            free -= len(members)
        if (slots >= 0).all():
            return seed, displacements, slots
    raise ValueError("no minimal perfect hash found; are there repeated keys?")


def pack_shard(first_row: int, keys: list, occurrences: list[int], payloads: list[bytes], id_bytes: int) -> bytes:
    """One shard as bytes; payloads are unsigned 32-bit ids, stored with ``id_bytes`` bytes each."""
    nulls = np.array([k is None for k in keys], dtype=np.uint8)
    plain = np.array([0 if k is None else k for k in keys], dtype=np.int64)
    occurrence = np.array(occurrences, dtype=np.int32)
    lengths = np.array([len(p) // 4 for p in payloads], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    seed, displacements, slots = build_index(plain, nulls, occurrence)
    hashes = key_hashes(plain, nulls, occurrence, seed)
    fingerprints, ranks = np.zeros(len(keys), dtype=np.uint32), np.zeros(len(keys), dtype=np.int32)
    fingerprints[slots] = hashes.astype(np.uint32)
    ranks[slots] = np.arange(len(keys))
    ids = np.frombuffer(b"".join(payloads), dtype="<u4")
    header = _HEADER.pack(len(keys), int(offsets[-1]), id_bytes, len(displacements), seed, first_row)
    arrays = [plain, nulls, occurrence, offsets, displacements, fingerprints, ranks, ids.astype(f"<u{id_bytes}")]
    return b"".join([MAGIC, header, *(a.tobytes() for a in arrays)])


class Shard:
    """Reads one shard from its bytes."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC or raw[-8:] != TRAILER:
            raise ValueError("not a token shard, or cut off")
        self.documents, self.n_ids, self.id_bytes, buckets, self.seed, self.first_row = _HEADER.unpack_from(raw, 8)
        at = 8 + _HEADER.size
        kinds = [("<i8", self.documents), ("u1", self.documents), ("<i4", self.documents), ("<i8", self.documents + 1),
                 ("<u4", buckets), ("<u4", self.documents), ("<i4", self.documents), (f"<u{self.id_bytes}", self.n_ids)]
        parts = []
        for kind, count in kinds:
            parts.append(np.frombuffer(raw, dtype=kind, count=count, offset=at))
            at += parts[-1].nbytes
        self.keys, self.nulls, self.occurrences, self.offsets, self.displacements, self.fingerprints, self.ranks, self.ids = parts

    def find(self, keys, nulls, occurrences) -> np.ndarray:
        """File ranks of the keys, -1 for those that are not here."""
        keys, nulls, occurrences = np.asarray(keys, np.int64), np.asarray(nulls, np.uint8), np.asarray(occurrences, np.int32)
        if not self.documents:
            return np.full(len(keys), -1)
        hashes = key_hashes(keys, nulls, occurrences, self.seed)
        bucket = (hashes >> np.uint64(32)).astype(np.int64) % len(self.displacements)
        slots = _slots(hashes, self.displacements[bucket], self.documents)
        ranks = self.ranks[slots].astype(np.int64)
        same = self.fingerprints[slots] == hashes.astype(np.uint32)
        same &= (self.keys[ranks] == keys) & (self.nulls[ranks] == nulls) & (self.occurrences[ranks] == occurrences)
        return np.where(same, ranks, -1)

    def ids_at(self, rank: int) -> np.ndarray:
        return self.ids[self.offsets[rank] : self.offsets[rank + 1]]


def write_tokens(
    docs: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", path: str | None = None,
    partitions: int | None = None, shard_ids: int = SHARD_IDS, end_id: int | None = END_ID,
) -> None:
    """Write the ids of every row's text to shard files in ``folder``, in ascending order of the id column.

    Rows are dealt out by ranges of the key (rows of equal key by a hash of their text), so each task holds
    a run of the order; it starts a new shard once ``shard_ids`` ids are gathered, so memory stays bounded. Null texts
    are empty, null keys come first, rows that repeat a key are told apart by their occurrence. The files are written through
    Spark's own committer: a lost task leaves nothing behind.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_bytes = 2 if _largest_id(path) < 1 << 16 else 4

    def shards(batches):
        enc = encoder(path)
        first, keys, occurrences, payloads, held, seen = 0, [], [], [], 0, 0
        last: object = shards  # no key yet
        tail = b"" if end_id is None else struct.pack("<I", end_id)
        for part in text_slices(batches, 1):
            for key, ids in zip(part.column(0).to_pylist(), enc.encode_rows(part.column(1), tail)):
                seen = seen + 1 if key == last else 0
                last = key
                keys.append(key)
                occurrences.append(seen)
                payloads.append(ids)
                held += len(ids) // 4
                if held >= shard_ids:
                    yield _record(pack_shard(first, keys, occurrences, payloads, id_bytes))
                    first, keys, occurrences, payloads, held = first + len(keys), [], [], [], 0
        if keys:
            yield _record(pack_shard(first, keys, occurrences, payloads, id_bytes))

    rows = docs.select(F.col(id_column).cast("long").alias("key"), F.col(text_column).alias("text"))
    ordered = rows.repartitionByRange(partitions, "key", F.xxhash64("text")).sortWithinPartitions("key", F.xxhash64("text"))
    # The text writer passes bytes through; with one record in a file, its line end is the trailer.
    (
        ordered.mapInArrow(shards, "shard binary")
        .select(F.col("shard").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .option("lineSep", TRAILER.decode())
        .text(folder)
    )


def _largest_id(path: str | None) -> int:
    return max(load_tokenizer(path or vocabulary_path()).get_vocab(with_added_tokens=True).values())


def _record(raw: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["shard"])


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard, shard_row), each document found in its shard through the index.

    ``start`` counts the ids of all documents before it. Shards are read once; their sizes (a row for each)
    are then summed in key order.
    """
    def read(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(content.as_buffer().to_pybytes())
                ranks = shard.find(shard.keys, shard.nulls, shard.occurrences)
                if (ranks < 0).any():
                    raise ValueError(f"{name}: the index misses a key that the shard holds")
                crcs = [zlib.crc32(shard.ids_at(r).astype("<u4").tobytes()) for r in ranks.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.keys, pa.int64(), mask=shard.nulls.astype(bool)),
                        pa.array(shard.offsets[ranks], pa.int64()),
                        pa.array(shard.offsets[ranks + 1] - shard.offsets[ranks], pa.int64()),
                        pa.array(crcs, pa.int64()),
                        pa.array([name] * len(crcs), pa.string()),
                        pa.array(ranks + shard.first_row, pa.int64()),
                    ],
                    ["doc_id", "local_start", "n_tokens", "ids_crc32", "shard", "shard_row"],
                )

    found = park(
        _files(spark, folder)
        .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "content")
        .mapInArrow(read, "doc_id long, local_start long, n_tokens long, ids_crc32 long, shard string, shard_row long"),
        "tokens",
    )
    return _with_starts(found)


def _with_starts(found: DataFrame) -> DataFrame:
    sizes = found.groupBy("shard").agg(F.sum("n_tokens").alias("ids"), F.min("shard_row").alias("first_row"))
    part = F.regexp_extract("shard", r"part-(\d+)", 1).cast("long")
    before = Window.orderBy(part, "first_row").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    starts = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return found.join(starts, "shard").select(
        "doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "shard", "shard_row"
    )


def lookup(spark: SparkSession, folder: str, wanted: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of the first row of each wanted key; keys that are not stored give no row, repeated ones one row.

    Shards list the runs of ``PAGE`` keys that they hold; a wanted key goes only to the shards that hold its run, and
    each finds it through its index.
    """
    def list_pages(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(content.as_buffer().to_pybytes())
                runs = np.unique(shard.keys[shard.nulls == 0] // PAGE)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(runs), pa.string()), pa.array(runs, pa.int64())], ["name", "page"])

    def get(batches):
        for batch in batches:
            for content, keys in zip(batch.column(0), batch.column(1).to_pylist()):
                shard = Shard(content.as_buffer().to_pybytes())
                ranks = shard.find(keys, [0] * len(keys), [0] * len(keys))
                hits = [(k, r) for k, r in zip(keys, ranks.tolist()) if r >= 0]
                ids = pa.array([shard.ids_at(r).astype(np.int64) for _, r in hits], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in hits], pa.int64()), ids], ["doc_id", "ids"])

    files = _files(spark, folder).select("path", "content")
    runs = files.mapInArrow(list_pages, "name string, page long")
    keys = wanted.select(F.col(id_column).cast("long").alias("key")).where("key is not null").distinct()
    routed = keys.withColumn("page", ((F.col("key") - F.pmod("key", F.lit(PAGE))) / PAGE).cast("long")).join(runs, "page")
    per_shard = routed.groupBy("name").agg(F.collect_set("key").alias("keys"))
    return files.join(per_shard, files["path"] == per_shard["name"]).select("content", "keys").mapInArrow(get, "doc_id long, ids array<long>")
