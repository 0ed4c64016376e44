"""Byte-pair encoding and decoding of our own, with forced boundaries.

A byte pair that stands inside no token of the vocabulary can never be merged over, so the text
falls apart there for certain. Texts are cut first before spaces, then by the pre-token pattern, then at those pairs;
each fragment is merged alone and the ids are concatenated. Both cuts feed memos of bounded size.
"""

from __future__ import annotations

import hashlib
import json
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyloom.llm.encoder import batches_of_text, pieces, vocabulary_path

MEMO_PIECES = 300_000
MEMO_FRAGMENTS = 250_000

_codecs: dict[str, ForcedBoundaryBpe] = {}


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ForcedBoundaryBpe:
    def __init__(self, path: str):
        import public_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {raw(token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        #: By the two ids side by side: the merge's rank; by rank: the id that it makes.
        self.ranks = {vocabulary[raw(a)] << 32 | vocabulary[raw(b)]: rank for rank, (a, b) in enumerate(merges)}
        self.made = [vocabulary[raw(a) + raw(b)] for a, b in merges]
        self.byte_ids = [vocabulary[bytes([b])] for b in range(256)]
        size = 1 + max([*vocabulary.values(), *self.special.values()])
        self.tokens = [b""] * size
        for token, i in vocabulary.items():
            self.tokens[i] = token
        for content, i in self.special.items():
            self.tokens[i] = content.encode()
        self.decimals = [str(i) for i in range(size)]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.inner_pairs = {token[i : i + 2] for token in vocabulary for i in range(len(token) - 1)}
        self.is_inner = bytearray(1 << 16)
        for first, second in self.inner_pairs:
            self.is_inner[first << 8 | second] = 1
        #: Texts may be cut before a space only if no token holds one after anything but white space.
        spaces = {chr(c).encode()[-1:] for c in range(0x3001) if chr(c).isspace()}
        self.cut_at_spaces = all(p[:1] in spaces for p in self.inner_pairs if p[1:] == b" ")
        self.piece_memo: dict[str, tuple[int, ...]] = {}
        self.met_again: set[str] = set()
        self.fragment_memo: dict[bytes, tuple[int, ...]] = {}

    def fragments(self, pretoken: bytes) -> list[bytes]:
        """The pre-token cut at every byte pair that stands inside no token."""
        inner = self.is_inner
        cuts = [at for at, (x, y) in enumerate(zip(pretoken, pretoken[1:]), 1) if not inner[x << 8 | y]]
        if not cuts:
            return [pretoken]
        return [pretoken[a:b] for a, b in zip([0, *cuts], [*cuts, len(pretoken)])]

    def _merge(self, fragment: bytes) -> tuple[int, ...]:
        parts = [self.byte_ids[b] for b in fragment]
        rank_of, made, never = self.ranks.get, self.made, len(self.ranks)
        ranks = [rank_of(a << 32 | b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            at = ranks.index(best)
            parts[at] = new = made[best]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] << 32 | new, never)
            if at < len(ranks):
                ranks[at] = rank_of(new << 32 | parts[at + 1], never)
        return tuple(parts)

    def _long_merge(self, fragment: bytes) -> tuple[int, ...]:
        """The same merges with a heap: n log n for fragments of many bytes, such as a line of dashes."""
        parts: list[int | None] = [self.byte_ids[b] for b in fragment]
        end = len(parts)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        rank_of = lambda i, j: self.ranks.get(parts[i] << 32 | parts[j])
        heap = [(r, i, i + 1) for i in range(end - 1) if (r := rank_of(i, i + 1)) is not None]
        heapify(heap)
        while heap:
            rank, i, j = heappop(heap)
            if parts[i] is None or after[i] != j or parts[j] is None or rank_of(i, j) != rank:
                continue
            parts[i], parts[j] = self.made[rank], None
            after[i] = after[j]
            if after[j] < end:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < end and (r := rank_of(a, b)) is not None:
                    heappush(heap, (r, a, b))
        return tuple(p for p in parts if p is not None)

    def _encode_piece(self, text: str) -> tuple[int, ...]:
        out: tuple[int, ...] = ()
        memo = self.fragment_memo
        letters = text[1:] if text.startswith(" ") else text
        if letters.isalpha():
            pretokens = [text]
        elif letters[-1:] in (",", ".") and letters[:-1].isalpha():
            pretokens = [text[:-1], text[-1]]
        else:
            pretokens = self.pattern.findall(text)
        for pretoken in pretokens:
            for fragment in self.fragments(pretoken.encode()):
                ids = memo.get(fragment)
                if ids is None:
                    ids = (self._merge if len(fragment) < 100 else self._long_merge)(fragment)
                    if len(memo) >= MEMO_FRAGMENTS:
                        memo.clear()
                    if len(fragment) < 100:
                        memo[fragment] = ids
                out += ids
        return out

    def _encode_plain(self, text: str) -> list[int]:
        if not self.cut_at_spaces:
            return list(self._encode_piece(text))
        parts = pieces(text)
        parts[0] = " " + parts[0]  # marks the piece that stands first in its text
        memo, here = self.piece_memo, set(parts)
        missing = here.difference(memo)
        self.met_again |= here.difference(missing)
        for piece in missing:
            memo[piece] = self._encode_piece(piece[1:] if piece.startswith(" ") else " " + piece)
        ids = list(chain.from_iterable(map(memo.__getitem__, parts)))
        if len(memo) > MEMO_PIECES:  # pieces met once go first
            kept = self.met_again if len(self.met_again) < 0.8 * MEMO_PIECES else here
            self.piece_memo = {piece: memo[piece] for piece in kept}
            self.met_again = set()
        return ids

    def encode(self, text: str) -> list[int]:
        if not any(s in text for s in self.special):
            return self._encode_plain(text) if text else []
        out: list[int] = []
        for part in self.special_split.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self._encode_plain(part)
        return out

    def decode(self, ids) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", errors="replace")


def codec(path: str | None = None) -> ForcedBoundaryBpe:
    """This Python worker's codec for a vocabulary file of the ``tokenizers`` library."""
    path = path or vocabulary_path()
    if path not in _codecs:
        _codecs[path] = ForcedBoundaryBpe(path)
    return _codecs[path]


def encode_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids array<int>) of every row; null and empty texts have no ids. One pass, no shuffle."""
    def encode(batches):
        bpe = codec(path)
        for batch in batches:
            for start, texts in batches_of_text(batch.column(1)):
                ids = pa.array([bpe.encode(t) for t in texts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), ids], [id_column, "ids"])

    rows = docs.select(id_column, text_column)
    return rows.mapInArrow(encode, f"{id_column} {rows.schema[0].dataType.simpleString()}, ids array<int>")


def decode_ids(rows: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text) of rows of ids; null ids give a null text, bytes that are no UTF-8 the replacement sign."""
    def decode(batches):
        bpe = codec(path)
        for batch in batches:
            texts = [None if v is None else bpe.decode(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_column, "text"])

    picked = rows.select(id_column, ids_column)
    return picked.mapInArrow(decode, f"{id_column} {picked.schema[0].dataType.simpleString()}, text string")


def round_trip_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded in one pass without a shuffle.

    Null and empty texts: no tokens and the digests of the empty string. Rows with a null or repeated id are
    rows like others; other columns are not read.
    """
    def digest(batches):
        bpe = codec(path)
        sha = lambda text: hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
        for batch in batches:
            for start, texts in batches_of_text(batch.column(1)):
                counts, encoded, decoded = [], [], []
                for text in texts:
                    ids = bpe.encode(text)
                    counts.append(len(ids))
                    encoded.append(sha(",".join(map(bpe.decimals.__getitem__, ids))))
                    decoded.append(sha(bpe.decode(ids)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)],
                    [id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(id_column, text_column)
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(digest, f"{id_column} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
