"""Token ids by the ``tokenizers`` library, with a bounded memo over pieces of text.

The byte-level split of the vocabulary never joins a space to what stands before it, so a text may be
cut before every space that a non-space character follows. A slice of texts is cut as one run of bytes and its distinct pieces are found by Arrow.
The library sees each distinct piece once, until the memo is full; the ids of all texts are then gathered in one go. They are
the library's own, and equal to those of the uncut text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

from tallyloom.llm.words import text_buffers  # noqa: E402

VOCABULARY = "byte_bpe_50k.json"
MEMO_PIECES = 600_000
TEXT_CHARS_AT_ONCE = 1_000_000
END_ID = 0

_ODD_SPACE = re.compile(r" \s")
_CUT = re.compile(r" (?=\S)")
_SIGNS = (b",", b".")
_WHITE = tuple(bytes([c]) for c in (*range(9, 14), *range(28, 33)))
#: White space: bytes of ASCII, and the first byte of longer characters with the second bytes that may be some.
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[c[0] for c in _WHITE]] = True
_SPACE_LEADS = {0xC2: [0x85, 0xA0], 0xE1: [0x9A, 0xA0], 0xE2: [0x80, 0x81], 0xE3: [0x80]}
_encoders: dict[str, MemoEncoder] = {}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pieces(text: str) -> list[str]:
    """The text cut before single spaces; all pieces but the first have lost that space."""
    return _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")


def load_tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def batches_of_text(values, most: int = TEXT_CHARS_AT_ONCE):
    """(start, texts) slices of an Arrow column of at most ``most`` characters, or one long text; null: empty."""
    start, held, chars = 0, [], 0
    for at, value in enumerate(values):
        text = value.as_py() or ""
        if held and chars + len(text) > most:
            yield start, held
            start, held, chars = at, [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield start, held


def cut_before(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where a space stands before a character that surely is no white space, within one text."""
    at = np.flatnonzero(raw[:-1] == 32) if len(raw) else np.zeros(0, np.int64)
    after = raw[at + 1]
    beyond = raw[np.minimum(at + 2, len(raw) - 1)] if len(raw) else after
    space = _SPACES[after]
    for lead, second in _SPACE_LEADS.items():
        space |= (after == lead) & np.isin(beyond, second)
    last = np.zeros(len(raw) + 1, dtype=bool)
    last[bounds[1:] - 1] = True  # what follows it is another text
    return at[~space & ~last[at]]


class MemoEncoder:
    """Encodes texts to unsigned 32-bit ids."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        self.library = load_tokenizer(path)
        self.memo_pieces = memo_pieces
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.byte_lengths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, token_id in vocabulary.items():
            self.byte_lengths[token_id] = len(token)  # one character for each byte
        #: The same model without pre-tokens, for single words written in the vocabulary's letters for bytes.
        spec = json.loads(self.library.to_str())
        self.words = Tokenizer.from_str(json.dumps(spec | {"pre_tokenizer": None}))
        self.signs = {c: self._ids(c.decode()) for c in _SIGNS}
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        #: Piece, with its leading space, to its number; where its ids begin and end; how many slices held it.
        self.memo: dict[bytes, int] = {}
        self.starts, self.ends, self.met = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.ids = np.zeros(0, dtype=np.uint32)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids, one ``bytes`` per text."""
        return list(self.encode_rows(pa.array(texts, pa.large_string())))

    def encode_rows(self, column: pa.Array, tail: bytes = b"") -> Iterator[bytes]:
        """The same for a column, with ``tail`` behind each text's ids; nulls are empty."""
        ids, ends = self.encode_column(column)
        raw, start = ids.astype("<u4", copy=False).tobytes(), 0
        for stop in (4 * ends).tolist():
            yield raw[start:stop] + tail
            start = stop

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids end); nulls are empty."""
        raw, bounds = text_buffers(column)
        cuts = cut_before(raw, bounds)
        odd = self._with_special(raw, bounds)
        if len(odd):  # such texts stay whole
            cuts = cuts[~np.isin(np.searchsorted(bounds, cuts, side="right") - 1, odd)]
        filled = np.flatnonzero(np.diff(bounds))
        starts = np.sort(np.concatenate([bounds[filled], cuts]))
        starts = starts[np.append(True, starts[1:] != starts[:-1])] if len(starts) else starts
        spelled = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(raw)]
        )
        coded = spelled.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.memo.get
        slots = np.fromiter((known(p, -1) for p in distinct), np.int64, len(distinct))
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            self._learn([distinct[i] for i in missing.tolist()], len(odd) > 0)
            slots[missing] = [self.memo[distinct[i]] for i in missing.tolist()]
        self.met[slots] += 1
        codes = coded.indices.to_numpy(zero_copy_only=False)
        begin, lengths = self.starts[slots][codes], (self.ends - self.starts)[slots][codes]
        stops = np.cumsum(lengths)
        ids = self.ids[np.repeat(begin - stops + lengths, lengths) + np.arange(stops[-1] if len(stops) else 0)]
        ends = np.append(0, stops)[np.searchsorted(starts, bounds[1:])]
        if len(self.memo) > self.memo_pieces:
            self._forget()
        return ids, ends

    def _with_special(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The texts that hold one of the vocabulary's special tokens."""
        spelled, found = raw.tobytes(), []
        for token in self.special:
            at = spelled.find(token) if token else -1
            while at >= 0:
                found.append(at)
                at = spelled.find(token, at + 1)
        return np.unique(np.searchsorted(bounds, found, side="right") - 1) if found else np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the pieces that several slices held, unless they are too many."""
        kept = self.met > 1
        if kept.sum() > 0.8 * self.memo_pieces:
            kept[:] = False
        slots = np.fromiter(self.memo.values(), np.int64, len(self.memo))
        slots = slots[kept[slots]]
        pieces = [piece for piece, slot in self.memo.items() if kept[slot]]
        lengths = (self.ends - self.starts)[slots]
        stops = np.cumsum(lengths)
        total = int(stops[-1]) if len(stops) else 0
        self.ids = self.ids[np.repeat(self.starts[slots] - stops + lengths, lengths) + np.arange(total)]
        self.memo = dict(zip(pieces, range(len(pieces))))
        self.starts, self.ends, self.met = stops - lengths, stops, np.ones(len(pieces), dtype=np.int64)

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _store(self, pieces: list[bytes], ids: list[np.ndarray], lengths: np.ndarray) -> None:
        """Take up new pieces whose ids follow one another in ``ids``."""
        base = len(self.ids)
        stops = base + np.cumsum(lengths, dtype=np.int64)
        self.memo.update(zip(pieces, range(len(self.starts), len(self.starts) + len(pieces))))
        self.starts = np.concatenate([self.starts, stops - lengths])
        self.ends = np.concatenate([self.ends, stops])
        self.met = np.concatenate([self.met, np.zeros(len(pieces), dtype=np.int64)])
        self.ids = np.concatenate([self.ids, *ids])

    def _learn(self, missing: list[bytes], special: bool) -> None:
        """Fill the memo: single words through the library's model, other pieces through the whole library.

        A comma or full stop behind a letter is a pre-token of its own, so such a piece is its word and that sign.
        """
        inner = [p for p in missing if p[:1] == b" "]
        odd = [p for p in missing if p[:1] != b" "]
        ended = [p for p in inner if p[-1:] in _SIGNS and p[-2:-1].isalpha()]
        words = {p[:-1] for p in ended if p[:-1] not in self.memo}
        words.update(p for p in inner if p[-1:] not in _SIGNS or not p[-2:-1].isalpha())
        single, plain = [], []
        for p in words:
            if p[1:].isalpha() and p.isascii():
                single.append(p)
            elif special or p[-1:] in _WHITE or p[-1] > 127 and p.decode()[-1].isspace() or len(p) < 2:
                odd.append(p)
            else:
                plain.append(p)
        if odd:
            found = self.library.encode_batch_fast([p.decode() for p in odd], add_special_tokens=False)
            ids = [np.asarray(f.ids, dtype=np.uint32) for f in found]
            self._store(odd, ids, np.array([len(i) for i in ids], dtype=np.int64))
        groups = [single[at : at + 2000] for at in range(0, len(single), 2000)]
        spelled = [["\u0120" + p[1:].decode() for p in g] for g in groups]
        self._keep(groups, self.words.encode_batch_fast(spelled, is_pretokenized=True, add_special_tokens=False))
        groups = [plain[at : at + 2000] for at in range(0, len(plain), 2000)]
        self._keep(groups, self.library.encode_batch_fast([b"".join(g).decode() for g in groups], add_special_tokens=False))
        for sign, own in self.signs.items():
            pieces = [p for p in ended if p[-1:] == sign]
            if pieces:
                slots = np.array([self.memo[p[:-1]] for p in pieces], dtype=np.int64)
                lengths = self.ends[slots] - self.starts[slots] + len(own)
                stops = np.cumsum(lengths)
                ids = np.empty(stops[-1], dtype=np.uint32)
                for k in range(len(own)):
                    ids[stops - len(own) + k] = own[k]
                word = np.repeat(self.starts[slots] - stops + lengths, lengths) + np.arange(stops[-1])
                inside = np.arange(stops[-1]) < np.repeat(stops - len(own), lengths)
                ids[inside] = self.ids[word[inside]]
                self._store(pieces, [ids], lengths)

    def _keep(self, groups: list[list[bytes]], encoded) -> None:
        """Cut the ids of joined pieces at the pieces' ends, found by the tokens' byte lengths."""
        pieces, every, lengths = [], [], []
        for group, found in zip(groups, encoded):
            ids = np.asarray(found.ids, dtype=np.uint32)
            ends = np.cumsum(self.byte_lengths[ids])
            stops = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)))
            cuts = np.searchsorted(ends, stops) + 1
            if not np.array_equal(ends[cuts - 1], stops):
                raise ValueError("a token crosses a cut; the vocabulary joins a space to the text before it")
            pieces += group
            every.append(ids)
            lengths.append(np.diff(cuts, prepend=0))
        if pieces:
            self._store(pieces, every, np.concatenate(lengths))


def encoder(path: str | None = None) -> MemoEncoder:
    """This Python worker's encoder for a vocabulary file."""
    path = path or vocabulary_path()
    if path not in _encoders:
        _encoders[path] = MemoEncoder(path)
    return _encoders[path]
