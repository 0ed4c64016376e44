"""Document quality from line labels: a chain CRF over the lines, its marginals weighted by the lines' lengths.

A line is described by what it is made of (kinds of characters, words said again) and by the same of the lines before and
after it. The model is fitted on a bounded sample of labelled documents, each of whose lines takes the document's label.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.crf import ChainCrf, fit
from tallyloom.llm.encoder import batches_of_text

SAMPLE_DOCUMENTS = 3000
CHAIN_LINES = 32  # longest chain in training; longer documents are several chains there
KEEP_SCORE = 0.7
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{}~"
_KINDS = ["upper", "lower", "digit", "space", "bang", "bar", "symbol", "stop", "newline"]
_OWN = 13


def _kind_table() -> np.ndarray:
    table = np.full(256, _KINDS.index("lower"), dtype=np.uint8)  # bytes of other scripts count as letters
    table[:128] = _KINDS.index("stop")
    for kind, characters in (
        ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("lower", b"abcdefghijklmnopqrstuvwxyz"), ("digit", b"0123456789"),
        ("space", b" \t\r\v\f"), ("bang", b"!?"), ("bar", b"|"), ("symbol", _SYMBOLS), ("newline", b"\n"),
    ):
        table[np.frombuffer(characters, np.uint8)] = _KINDS.index(kind)
    return table


_TABLE = _kind_table()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, lines by text, bytes by line); a text without a line break, even an empty one, is one line."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = b"\n".join(raw) + b"\n"
    kinds = _TABLE[np.frombuffer(joined, dtype=np.uint8)]
    ends = np.flatnonzero(kinds == _KINDS.index("newline"))
    starts = np.concatenate([[0], ends[:-1] + 1])
    counts = np.stack(
        [np.add.reduceat(kinds == k, starts, dtype=np.int32) for k in range(len(_KINDS) - 1)], axis=1
    ).astype(np.float64)
    sizes = (ends - starts).astype(np.float64)
    lines = np.array([r.count(b"\n") + 1 for r in raw], dtype=np.int64)
    said = np.empty((len(ends), 3))
    for at, line in enumerate(joined[:-1].split(b"\n")):
        words = line.split()
        n = len(words)
        again = sum(map(eq, words, words[1:])) if n > 1 else 0
        said[at] = n, again / max(1, n - 1), 1 - len(set(words)) / n if n else 0
    upper, lower, digit, space, bang, bar, symbol, stop = counts.T
    words, size = np.maximum(said[:, 0], 1), np.maximum(sizes, 1)
    own = np.column_stack(
        [
            upper / np.maximum(upper + lower, 1), digit / size, np.minimum(bang / words, 3), np.minimum(bar / words, 3),
            np.minimum(symbol / words, 6), np.minimum(stop / words, 3), (upper + lower) / size, np.log1p(said[:, 0]),
            np.minimum((size - space) / words, 30), said[:, 1], said[:, 2], sizes == 0, symbol > 0,
        ]
    )
    first, last = np.cumsum(lines) - lines, np.cumsum(lines) - 1
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    ends_of_text = np.zeros((len(own), 2))
    ends_of_text[first, 0], ends_of_text[last, 1] = 1, 1
    return np.hstack([own, before, after, ends_of_text]), lines, sizes


def score_texts(model: ChainCrf, texts: list[str]) -> np.ndarray:
    """The length-weighted mean probability that a line is good."""
    rows, lines, sizes = line_features(texts)
    good, weights = model.marginals(rows, lines), sizes + 1
    firsts = np.cumsum(lines) - lines
    return np.add.reduceat(good * weights, firsts) / np.add.reduceat(weights, firsts)


def _slices(batch: pa.RecordBatch, column: int, most: int = 1_000_000):
    """(start, texts) of at most ``most`` characters together, or one text."""
    return batches_of_text(batch.column(column), most)


def held_out(id_column: str = "doc_id"):
    """True for ids left out of training: crc32 of the id as text, modulo 4, is 2. Null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "quality", sample: int = SAMPLE_DOCUMENTS) -> ChainCrf:
    """Fit on at most ``sample`` labelled documents that are not held out, those whose ids have the least hashes.

    Null labels and ids are left out; an id with several labels takes the largest. Their lines' numbers come to the driver.
    """
    chosen = (
        labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("key"))
        .agg(F.max(label_column).cast("int").alias("mark"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(sample)
    )

    def describe(batches):
        for batch in batches:
            for start, texts in _slices(batch, 0):
                rows, lines, _ = line_features(texts)
                cuts = np.concatenate([[0], np.cumsum(lines)])
                own = [rows[a:b].astype("<f4").tobytes() for a, b in zip(cuts, cuts[1:])]
                marks = batch.column(1).slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([marks, pa.array(lines, pa.int64()), pa.array(own, pa.binary())], ["mark", "lines", "rows"])

    found = (
        docs.select(F.col(id_column).alias("key"), F.col(text_column).alias("text"))
        .join(F.broadcast(chosen), "key")  # at most ``sample`` rows
        .select("text", "mark")
        .mapInArrow(describe, "mark int, lines long, rows binary")
        .collect()
    )
    found.sort(key=lambda r: (r["mark"], r["lines"], r["rows"]))  # the same sums whatever the order of tasks
    rows = np.frombuffer(b"".join(r["rows"] for r in found), "<f4").reshape(-1, 3 * _OWN + 2).astype(np.float64)
    marks = np.repeat([r["mark"] for r in found], [r["lines"] for r in found]) if found else np.zeros(0)
    chains = [min(CHAIN_LINES, r["lines"] - at) for r in found for at in range(0, r["lines"], CHAIN_LINES)]
    return fit(rows, marks, np.array(chains, dtype=np.int64))


def score_documents(docs: DataFrame, model: ChainCrf, id_column: str = "doc_id", text_column: str = "text",
                    threshold: float = KEEP_SCORE) -> DataFrame:
    """(id, held_out, score, predicted) of every row, in one pass without a shuffle.

    Null texts score as empty ones, which are one empty line. Null and repeated ids are rows like others; other columns are not read.
    """
    def score(batches):
        for batch in batches:
            for start, texts in _slices(batch, 2):
                found = score_texts(model, texts)
                own = [batch.column(i).slice(start, len(texts)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(found), pa.array((found >= threshold).astype(np.int32))], [id_column, "held_out", "score", "predicted"]
                )

    rows = docs.select(F.col(id_column), held_out(id_column).alias("held_out"), F.col(text_column))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(score, f"{id_column} {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: ChainCrf, text_column: str = "text", threshold: float = KEEP_SCORE) -> DataFrame:
    """The rows, all their columns kept, whose text scores at least ``threshold``."""
    place = docs.columns.index(text_column)

    def keep(batches):
        for batch in batches:
            for start, texts in _slices(batch, place):
                yield batch.slice(start, len(texts)).filter(pa.array(score_texts(model, texts) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
