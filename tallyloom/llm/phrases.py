"""Collocations: frequent phrases of two to four words, scored by how well their parts stick together.

A phrase can only be frequent if its words and its pairs are. So the texts are read three times: for the words; for the
pairs of frequent words; for the phrases whose pairs are all frequent. What was found before travels as
bitmaps of bounded size, and what they let through by chance is counted exactly like the rest. Each task counts in HAT-tries that spill whole
subtrees as sorted runs. Runs of words and phrases are parked, dealt out by ranges of phrases, which keep a prefix together
unless it is a hot one, and summed there. Pairs, most of which are rare, travel as packed keys by ranges of their hash, which only
decide what the last pass looks at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm import bitmap
from tallyloom.llm.hat_trie import MOST_IDS, HatTrie
from tallyloom.llm.words import LOWER, Words, byte_kinds, text_buffers, text_slices
from tallyloom.session import park

KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
LEAST_COUNT = 30
LONGEST = 4
SALTS = 32
RUN_ROWS = 100_000
WORDS_A_PART = 5_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = zlib.crc32(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def joined_hashes(first: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Hashes of phrases from the hashes of their words; those of single words are the words' own."""
    out = first
    for h in others:
        out = (out ^ (out >> np.uint64(31))) * _MIX + h
        out = (out ^ (out >> np.uint64(29))) * _MIX
    return out


class Vocabulary:
    """Task-local ids of one language's frequent words, with their hashes."""

    def __init__(self, lang: str, frequent: bytes | None):
        self.lang, self.frequent = lang, frequent
        self.ids: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.hashes = np.zeros(0, dtype=np.uint64)

    def ids_of(self, words: list[bytes]) -> np.ndarray:
        """Ids of distinct words, -1 for infrequent ones."""
        found = np.fromiter((self.ids.get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        hashes = word_hashes([words[i] for i in missing.tolist()], self.lang)
        if self.frequent is not None:
            kept = bitmap.holds(self.frequent, hashes)
            missing, hashes = missing[kept], hashes[kept]
        new = [words[i] for i in missing.tolist()]
        found[missing] = np.arange(len(self.words), len(self.words) + len(new))
        self.ids.update(zip(new, range(len(self.words), len(self.words) + len(new))))
        self.words += new
        self.hashes = np.concatenate([self.hashes, hashes])
        return found


def _windows(ids: np.ndarray, hashes: np.ndarray, inside: np.ndarray, lengths: list[int], pairs: bytes | None):
    """(words, columns of ids) of the phrases of each length within pieces whose words, and pairs by the bitmap, are frequent.

    ``inside`` tells for each word but the last whether the next one belongs to its piece.
    """
    linked = inside & (ids[:-1] >= 0) & (ids[1:] >= 0)
    if pairs is not None:
        at = np.flatnonzero(linked)
        linked[at] = bitmap.holds(pairs, joined_hashes(hashes[ids[at]], hashes[ids[at + 1]]))
    chain = linked
    for words in range(2, max(lengths) + 1):
        if words > 2:
            chain = chain[:-1] & linked[words - 2 :]
        if words in lengths:
            at = np.flatnonzero(chain)
            yield words, [ids[at + k] for k in range(words)]


def _counted(batches, lengths: list[int], known: bytes | None, pairs: bytes | None, trie: dict):
    """(lang, vocabulary, trie) whenever a trie has to spill: ``full`` ones their largest half, others everything."""
    tries: dict[str, tuple[Vocabulary, dict[int, HatTrie]]] = {}
    for part in text_slices(batches, 1):
        langs = part.column(0).dictionary_encode()
        codes = np.asarray(langs.indices)
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            raw, bounds = text_buffers(part.column(1).take(pa.array(np.flatnonzero(codes == code))))
            found = Words(LOWER[raw], bounds, KINDS)
            if lang not in tries:
                tries[lang] = (Vocabulary(lang, known), {k: HatTrie(k, **trie) for k in lengths})
            vocabulary, counts = tries[lang]
            ids = vocabulary.ids_of(found.distinct)
            if 1 in counts:
                own = np.bincount(found.codes, minlength=len(ids))
                counts[1].add([ids[ids >= 0]], own[ids >= 0])
            elif len(found) > 1:
                pieces = found.pieces()
                for words, columns in _windows(ids[found.codes], vocabulary.hashes, pieces[1:] == pieces[:-1], lengths, pairs):
                    counts[words].add(columns)
            if len(vocabulary.words) > MOST_IDS // 2:
                yield from ((lang, vocabulary, c, True) for c in counts.values())
                del tries[lang]
        every = [(lang, v, c, False) for lang, (v, counts) in tries.items() for c in counts.values()]
        while every and sum(c.entries for _, _, c, _ in every) > every[0][2].most:
            yield max(every, key=lambda item: item[2].entries)
    for lang, (vocabulary, counts) in tries.items():
        yield from ((lang, vocabulary, c, True) for c in counts.values())


def phrase_runs(docs: DataFrame, lengths: list[int], known=None, pairs=None, **trie) -> DataFrame:
    """(lang, phrase, words, n) with the phrases that may be frequent, several rows a phrase; ``docs`` holds lang and text.

    ``known`` and ``pairs`` are broadcast bitmaps of the frequent words and pairs.
    """

    def runs(batches):
        for lang, vocabulary, counts, everything in _counted(batches, lengths, known and known.value, pairs and pairs.value, trie):
            spelled = np.array([*vocabulary.words, b""], dtype=object)
            ids, times = counts.spill(everything)
            for at in range(0, len(ids), RUN_ROWS):
                part = ids[at : at + RUN_ROWS]
                phrases = spelled[part[:, 0]]
                for column in part.T[1:]:
                    phrases = phrases + b" " + spelled[column]
                n = len(part)
                columns = [
                    pa.array([lang] * n, pa.string()),
                    pa.array(phrases, pa.binary()).cast(pa.string()),
                    pa.array(np.full(n, counts.words, dtype=np.int32)),
                    pa.array(times[at : at + RUN_ROWS]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "n"])

    return docs.mapInArrow(runs, "lang string, phrase string, words int, n long")


def summed(runs: DataFrame) -> DataFrame:
    """(lang, phrase, words, n): the runs of all tasks merged within ranges of phrases."""
    return runs.repartitionByRange("lang", "phrase").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))


def frequent_pair_hashes(docs: DataFrame, known, least: int, parts: int, **trie) -> DataFrame:
    """(hash) of every pair of frequent words that stands ``least`` times or more; equal hashes count together.

    Each run is dealt out in ``parts`` ranges of hashes, as one row with its packed keys and counts, and merged there.
    """

    def runs(batches):
        for _, vocabulary, counts, everything in _counted(batches, [2], known.value, None, trie):
            ids, times = counts.spill(everything)
            hashes = joined_hashes(vocabulary.hashes[ids[:, 0]], vocabulary.hashes[ids[:, 1]])
            order = np.argsort(hashes)
            hashes, times = hashes[order], np.minimum(times[order], least).astype(np.uint8 if least < 256 else np.int64)
            part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            heads = np.flatnonzero(np.diff(part, prepend=-1))
            spans = list(zip(heads.tolist(), [*heads[1:].tolist(), len(part)]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[heads], pa.int32()),
                    pa.array([hashes[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([times[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                ["part", "keys", "counts"],
            )

    def merge(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), dtype=np.uint64)
        counts = np.frombuffer(b"".join(table["counts"].to_pylist()), dtype=np.uint8 if least < 256 else np.int64)
        order = np.argsort(keys)
        keys = keys[order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        enough = np.add.reduceat(counts[order].astype(np.int64), heads) >= least
        return pa.table({"hash": pa.array(keys[heads[enough]].view(np.int64))})

    rows = docs.mapInArrow(runs, "part int, keys binary, counts binary")
    return rows.groupBy("part").applyInArrow(merge, "hash long")


def _word_hashes(frequent: DataFrame) -> DataFrame:
    """(hash) of every frequent word, as tasks make it."""

    def of(batches):
        for batch in batches:
            langs, words = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = [word_hashes([w.encode()], lang)[0] for lang, w in zip(langs, words)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(out, dtype=np.uint64).view(np.int64))], ["hash"])

    return frequent.select("lang", "phrase").mapInArrow(of, "hash long")


def _broadcast(hashes: DataFrame):
    return hashes.sparkSession.sparkContext.broadcast(bitmap.build(hashes, "hash", hashes.count()))


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, **trie) -> tuple[DataFrame, DataFrame]:
    """((lang, total) words of each lang, (lang, phrase, words, n) of phrases of 1 to ``longest`` words with n >= ``least``), parked.

    ``docs`` holds lang and text. Eager: three passes over the texts.
    """
    runs = park(phrase_runs(docs, [1], **trie), "runs")
    totals = runs.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = park(summed(runs).where(F.col("n") >= least), "words")
    known = _broadcast(park(_word_hashes(frequent), "hashes"))
    spark = docs.sparkSession
    in_all = totals.agg(F.sum("total")).head()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), in_all // WORDS_A_PART + 1)
    pairs = _broadcast(park(frequent_pair_hashes(docs, known, least, parts, **trie), "pairs"))
    runs = park(phrase_runs(docs, list(range(2, longest + 1)), known, pairs, **trie), "runs")
    return totals, frequent.unionByName(park(summed(runs).where(F.col("n") >= least), "phrases"))


def _exact(column: str):
    return F.col(column).cast("decimal(20,0)")


def collocations(
    docs: DataFrame, top: int = 2000, least: int = LEAST_COUNT, longest: int = LONGEST, inside_percent: int = 80,
    text_column: str = "text", lang_column: str = "lang", **trie,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language by score, then count, then phrase.

    A phrase of 2 to ``longest`` words with a count a of at least ``least`` has for each cut the counts l and r of its two
    parts and the score floor(2000000 a / (l + r)); the lowest counts, ties going to the shorter first part. Phrases inside a longer frequent one with
    at least ``inside_percent`` of their own count go. n is the language's words. Null langs are ``und``; null and empty
    texts and texts without words hold nothing; repeated rows count each time; other columns are not read. Tables without
    frequent phrases give no rows. Eager: counts are parked.
    """
    rows = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"), F.col(text_column).alias("text"))
    totals, counted = frequent_phrases(rows, least, longest, **trie)
    candidates = counted.where("words > 1").withColumnRenamed("n", "a")
    parts = counted.where(F.col("words") < longest)

    split = F.split("phrase", " ", -1)
    cut = lambda start, size: F.array_join(F.slice(split, start, size), " ")
    cuts = candidates.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", cut(F.lit(1), F.col("k")).alias("first"), cut(F.col("k") + 1, F.col("words")).alias("rest"))
    count_of = lambda part, name: parts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    cuts = cuts.join(count_of("first", "l"), ["lang", "first"]).join(count_of("rest", "r"), ["lang", "rest"])
    cuts = cuts.withColumn("score", F.expr("(2000000 * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = [(start, size) for size in range(2, longest) for start in range(1, longest - size + 2)]
    inside = F.array(*[F.when(F.col("words") >= start + size - 1 + (start == 1), cut(F.lit(start), F.lit(size))) for start, size in spans])
    longer = candidates.where("words > 2").select("lang", F.explode(F.array_compact(inside)).alias("phrase"), F.col("a").alias("within"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("within").alias("within"))
    weaker = F.col("within").isNull() | (100 * _exact("within") < inside_percent * _exact("a"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(weaker).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    thinned = kept.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = thinned.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    out = ranked.join(F.broadcast(totals), "lang") if totals.count() <= 1000 else ranked.join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
