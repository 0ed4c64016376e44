"""Language of documents and pages by Bayesian fusion of what the text, the markup, the address and the host say.

Text: naive Bayes over hashed byte trigrams, fitted on a bounded sample of each label's documents; the likelihood is tempered because
neighbouring trigrams are no independent evidence. Markup (declared language) and address suffix: how often each value goes with each
language, counted over all rows with the text's own posterior as weights. Host: the mean posterior of the host's other rows,
smoothed towards that of its parent domain, which is smoothed towards that of all rows. All counts are grouped aggregations.
A row whose text is better explained by random letters than by any language is undetermined (``und``), unless it declares a
language that the model has not learned: then nothing speaks against that language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.encoder import batches_of_text
from tallyloom.session import park

UNDETERMINED = "und"
BUCKETS = 1 << 15
SAMPLE_DOCUMENTS = 1500  # of each label
TEMPER = 0.1  # each trigram counts as this part of an independent observation
MOST_EVIDENCE = 40.0  # nats that the text may speak for one language over another
HOST_WEIGHT = 5.0  # rows that a parent's distribution counts for in its host's
FIELD_WEIGHT = 1.0  # rows that each language counts for with every declared value or suffix
KEEP_POSTERIOR = 0.5

_LETTERS = np.full(256, 32, dtype=np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class TrigramModel:
    languages: list[str]  # ends with ``und``
    log_likelihood: np.ndarray  # languages x buckets

    def evidence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(trigrams by text, log-likelihoods texts x languages), untempered."""
        codes, owner = trigrams(texts)
        counts = np.bincount(owner, minlength=len(texts))
        sums = np.stack([np.bincount(owner, weights=table[codes], minlength=len(texts)) for table in self.log_likelihood], axis=1)
        return counts, sums


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of each byte trigram of the lower-case letters; all else is a space, and spaces do not pile up."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    joined = np.frombuffer(b"\n\n" + b"\n\n".join(raw) + b"\n\n", dtype=np.uint8)
    letters = _LETTERS[joined]
    kept = np.flatnonzero((letters != 32) | (np.concatenate([[0], letters[:-1]]) != 32))
    letters = letters[kept].astype(np.uint32)
    code = (letters[:-2] << np.uint32(16) | letters[1:-1] << np.uint32(8) | letters[2:]) * np.uint32(2654435761) >> np.uint32(17)
    middle = letters[1:-1] != 32  # a trigram belongs to a word: its middle is a letter
    ends = np.cumsum([len(r) + 2 for r in raw])
    owner = np.searchsorted(ends, kept[1:-1][middle], side="left")
    return code[middle].astype(np.int64), owner


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", sample: int = SAMPLE_DOCUMENTS) -> TrigramModel:
    """Fit on at most ``sample`` documents of each label, those whose ids have the least hashes; every label is learned.

    The model has a row of ``BUCKETS`` doubles for each label.
    """
    marked = docs.select(F.col(id_column).alias("key"), F.col(label_column).cast("string").alias("mark"), F.col(text_column).alias("text")).dropna()
    sizes = park(marked.groupBy("mark").agg(F.approx_count_distinct("key").alias("ids")), "labels")
    drawn = F.xxhash64("key") / F.lit(2.0**64) + 0.5  # uniform in [0, 1): about twice the sample's ids are ranked, whatever the label's size
    low = marked.select("mark", "key").join(sizes, "mark").where(drawn * F.col("ids") < 2 * sample + 64).select("mark", "key").distinct()
    least = Window.partitionBy("mark").orderBy(F.xxhash64("key"), "key")
    chosen = park(low.withColumn("place", F.row_number().over(least)).where(F.col("place") <= sample).select("mark", "key"), "sampled")

    def count(batches):
        for batch in batches:
            for start, texts in batches_of_text(batch.column(1), 1_000_000):
                marks = batch.column(0).slice(start, len(texts)).to_pylist()
                codes, owner = trigrams(texts)
                names = sorted(set(marks))
                place = {m: i for i, m in enumerate(names)}
                number = np.array([place[m] for m in marks], dtype=np.int64)
                at, n = np.unique(number[owner] * BUCKETS + codes, return_counts=True)
                spoken = pa.array(names, pa.string()).take(pa.array(at // BUCKETS))
                yield pa.RecordBatch.from_arrays([spoken, pa.array(at % BUCKETS), pa.array(n)], ["mark", "bucket", "n"])

    counts = marked.join(chosen, ["mark", "key"], "left_semi").select("mark", "text").mapInArrow(count, "mark string, bucket long, n long")
    found = park(counts.groupBy("mark", "bucket").agg(F.sum("n").alias("n")), "trigrams").toPandas()  # at most BUCKETS rows a label
    languages = sorted(found["mark"].unique().tolist())
    table = np.full((len(languages) + 1, BUCKETS), 0.5)
    table[found["mark"].map({m: i for i, m in enumerate(languages)}).to_numpy(dtype=np.int64), found["bucket"].to_numpy()] += found["n"].to_numpy()
    table[-1] = 1  # random letters
    table /= table.sum(axis=1, keepdims=True)
    return TrigramModel([*languages, UNDETERMINED], np.log(table, out=table))


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without user and port; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def parent_of(host: Column) -> Column:
    """The last two labels of a host; a host of fewer is its own parent."""
    return F.when(F.size(F.split(host, r"\.")) > 2, F.substring_index(host, ".", -2)).otherwise(host)


def suffix_of(url: Column) -> Column:
    """What of an address tells of a language: the top-level domain, and the first part of the path if it has two letters."""
    path = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([A-Za-z]{2})(?:[-_/?#]|$)", 1))
    return F.concat_ws("/", F.substring_index(host_of(url), ".", -1), F.when(path != "", path))


def declared_in(html: Column) -> Column:
    """The primary tag of the language that a page's ``html`` element declares, in lower case; null where there is none."""
    tag = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", 1))
    return F.when(tag != "", tag)


def _softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _lists(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A column of lists as a matrix, zeros for null, and which rows are not null."""
    there = ~np.asarray(column.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    out = np.zeros((len(column), width))
    if there.any():
        out[there] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out, there


def identify(rows: DataFrame, model: TrigramModel, key: str, text: str, declared: str | None = None, suffix: str | None = None,
             host: str | None = None, parent: str | None = None, text_of=None) -> DataFrame:
    """(key, declared, suffix, host, language, posterior, text_language, accepted) of every row.

    ``declared``, ``suffix``, ``host`` and ``parent`` name columns; a null value, like a column not named, is no evidence.
    ``text_of`` turns the text column's value into text (for markup). Null and empty texts are no evidence either: the
    other fields then decide, and without any the language is ``und``. Rows of ``und`` and rows whose posterior stays below
    ``KEEP_POSTERIOR`` are not accepted, but for those with letters that declare a language unknown to the model: they are
    taken at their word, their posterior being that of no learned language. Null and repeated keys are rows like others. Eager: one pass over the texts stores the evidence.
    """
    count = len(model.languages)
    kinds = {"declared": declared, "suffix": suffix, "host": host, "parent": parent}

    def read(batches):
        for batch in batches:
            for start, texts in batches_of_text(batch.column(batch.num_columns - 1), 1_000_000):
                n, sums = model.evidence([text_of(t) for t in texts] if text_of else texts)
                weighed = TEMPER * sums
                weighed = np.maximum(weighed, weighed.max(axis=1, keepdims=True) - MOST_EVIDENCE)
                own = [batch.column(i).slice(start, len(texts)) for i in range(batch.num_columns - 1)]
                heard = pa.array(list(weighed - weighed.max(axis=1, keepdims=True)), pa.list_(pa.float64()))
                told = pa.array(list(_softmax(weighed)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*own, pa.array(n, pa.int64()), heard, told], names)

    picked = rows.select(F.col(key).alias("key"), *(F.col(c).cast("string").alias(k) if c else F.lit(None).cast("string").alias(k) for k, c in kinds.items()), F.col(text).alias("text"))
    names = ["key", *kinds, "n", "heard", "p"]
    schema = f"key {picked.schema[0].dataType.simpleString()}, declared string, suffix string, host string, parent string, n long, heard array<double>, p array<double>"
    evidence = park(picked.mapInArrow(read, schema), "evidence")
    spoken = evidence.where("n > 0")
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(count)]
    overall = spoken.agg(*sums).first()
    total = np.array([overall[i] or 0.0 for i in range(count)]) + 1.0
    world = total / total.sum()
    gathered = F.array(*(F.col(f"s{i}") for i in range(count)))

    def table(kind):
        """(value, sums by language) of one field, over all rows whose text speaks."""
        return spoken.where(F.col(kind).isNotNull()).groupBy(F.col(kind).alias(f"{kind}_value")).agg(*sums).select(f"{kind}_value", gathered.alias(f"{kind}_sums"))

    joined = evidence
    for kind, column in kinds.items():
        stored = park(table(kind), f"by-{kind}") if column else None
        joined = joined.join(stored, F.col(kind) == F.col(f"{kind}_value"), "left") if column else joined.withColumn(f"{kind}_sums", F.lit(None).cast("array<double>"))
    labels, silent_fields = np.array(model.languages), ("declared", "suffix", "host")
    learned = {"", *model.languages}

    def fuse(batches):
        for batch in batches:
            heard, _ = _lists(batch.column("heard"), count)
            own, n = _lists(batch.column("p"), count)[0], batch.column("n").to_numpy(zero_copy_only=False)
            own = own * (n > 0)[:, None]
            others = {}
            for kind in kinds:  # the row's own vote does not count for it
                sums, there = _lists(batch.column(f"{kind}_sums"), count)
                others[kind] = np.maximum(sums - own * there[:, None], 0)
            up = (others["parent"] + HOST_WEIGHT * world) / (others["parent"].sum(axis=1, keepdims=True) + HOST_WEIGHT)
            prior = (others["host"] + HOST_WEIGHT * up) / (others["host"].sum(axis=1, keepdims=True) + HOST_WEIGHT)
            scores = np.log(prior) + heard
            silent = n == 0
            for kind in silent_fields:
                given = ~np.asarray(batch.column(kind).is_null().to_numpy(zero_copy_only=False), dtype=bool)
                silent = silent & ~given
                if kind != "host":  # how much of each language goes with this value
                    scores += given[:, None] * np.log((others[kind] + FIELD_WEIGHT) / (total + FIELD_WEIGHT))
            fused = _softmax(scores)
            language = np.where(silent, UNDETERMINED, labels[fused.argmax(axis=1)])
            posterior = np.where(silent, 0.0, fused.max(axis=1))
            accepted = (language != UNDETERMINED) & (posterior >= KEEP_POSTERIOR) & (n > 0)
            said = batch.column("declared").to_pylist()
            unlearned = np.array([d is not None and d not in learned for d in said], dtype=bool) & (n > 0) & ~accepted
            language = np.where(unlearned, np.array(said, dtype=object), language)
            posterior = np.where(unlearned, fused[:, -1], posterior)
            accepted = accepted | unlearned
            spoken_as = [str(labels[i]) if m else None for i, m in zip(own.argmax(axis=1), n > 0)]
            kept = [batch.column(c) for c in ("key", "declared", "suffix", "host")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(language.tolist(), pa.string()), pa.array(posterior), pa.array(spoken_as, pa.string()), batch.column("n"), pa.array(accepted)],
                ["key", "declared", "suffix", "host", "language", "posterior", "text_language", "n", "accepted"],
            )

    kind_of_key = picked.schema[0].dataType.simpleString()
    return joined.select("key", *kinds, "n", "heard", "p", *(f"{kind}_sums" for kind in kinds)).mapInArrow(
        fuse,
        f"key {kind_of_key}, declared string, suffix string, host string, language string, posterior double, text_language string, n long, accepted boolean",
    )


def keep_identified(docs: DataFrame, model: TrigramModel, id_column: str = "doc_id", text_column: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """The rows, all their columns kept, whose language is determined. A row is known by its id and its text."""
    mark = F.xxhash64(id_column, text_column, declared, host)
    found = identify(docs.withColumn("tallyloom_mark", mark), model, "tallyloom_mark", text_column, declared, None, host)
    rejected = park(found.where(~F.col("accepted")).select(F.col("key").alias("tallyloom_rejected")).distinct(), "rejected")
    return docs.join(rejected, mark == F.col("tallyloom_rejected"), "left_anti")
