"""Column expressions that clean and match text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in the cleaning rules are Unicode's white
# space and four ASCII separators. The flags make \s mean the former and let a dot match a line end.
_FLAGS = "(?Us)"
SPACE = r"[\s\x1c-\x1f]"
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# A white space between a letter and a lower-case letter. The space comes first in the pattern, so
# the letter before it is looked at only where there is one.
_SPLIT_WORD = f"{_FLAGS}{SPACE}(?<=[A-Za-z].)(?=[a-z])"
_RUN_OF_SPACES = f"{_FLAGS}{SPACE}{{2,}}"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip(column: Column | str) -> Column:
    """Remove any white space, line breaks included, from both ends."""
    return F.trim(_col(column), F.lit(SPACES))


def _without_marks(text: Column) -> Column:
    """The text without NULs and bullets."""
    nothing = F.lit("")
    return F.replace(F.replace(text, F.lit("\x00"), nothing), F.lit("•"), nothing)


def clean_line(column: Column | str) -> Column:
    """Rejoin split words, collapse white space, drop NULs and bullets, strip.

    One white space between a letter and a lower-case letter goes away, so real word
    boundaries before lower-case words go away with it.
    """
    rejoined = F.regexp_replace(_col(column), _SPLIT_WORD, "")
    return strip(_without_marks(F.regexp_replace(rejoined, _RUN_OF_SPACES, " ")))


def clean_line_consuming(column: Column | str) -> Column:
    """The older cleaning: a letter used by one repair cannot take part in the next."""
    split_pair = f"{_FLAGS}([A-Za-z]){SPACE}([a-z])"
    rejoined = F.regexp_replace(_col(column), split_pair, "$1$2")
    return strip(_without_marks(F.regexp_replace(rejoined, f"{_FLAGS}{SPACE}+", " ")))


def contains_any(column: Column | str, words: Sequence[str]) -> Column:
    """Whether the text holds one of the words as a substring."""
    text = _col(column)
    return reduce(Column.__or__, (text.contains(word) for word in words), F.lit(False))


def _any_of(words: Sequence[str]) -> str:
    return "|".join(map(re.escape, words))


def lists_found(column: Column | str, lists: Mapping[str, Sequence[str]]) -> Column:
    """For each of some lists of words whether the text holds one of them as a substring, a struct by the lists' names.

    The same as ``contains_any`` of each, NULL text included, but texts are scanned once for all words, and those that hold any once for each list.
    Marked nondeterministic so that no condition on it makes Spark scan twice.
    """
    patterns = {name: _any_of(words) for name, words in lists.items() if words}
    either = "|".join(patterns.values())

    @F.arrow_udf(", ".join(f"`{name}` boolean" for name in lists))
    def found(texts: pa.Array) -> pa.Array:
        none = pc.and_(pc.is_null(texts), False)
        some = pc.match_substring_regex(texts, either) if patterns else none
        chosen = texts.filter(some)
        by_pattern = {p: pc.replace_with_mask(none, some.fill_null(False), pc.match_substring_regex(chosen, p)) for p in {*patterns.values()}}
        held = [by_pattern[patterns[name]] if name in patterns else none for name in lists]
        unknown = pc.if_else(pc.is_null(texts), pa.scalar(None, pa.bool_()), True)
        return pa.StructArray.from_arrays([pc.and_(x, unknown) for x in held], names=list(lists))

    return found.asNondeterministic()(_col(column))


def match_key(column: Column | str) -> Column:
    """What two lines must share to count as the same: lower-case ASCII letters and digits."""
    return F.regexp_replace(F.lower(_col(column)), "[^a-z0-9]+", "")


def product_key(column: Column | str) -> Column:
    """A product name as the marker lists spell it."""
    return strip(F.regexp_replace(F.lower(_col(column)), "[\"']", ""))


def like_anywhere(column: Column | str, pattern: str | None) -> Column:
    """Case-insensitive containment; ``%`` and ``_`` in the pattern are wildcards.

    A NULL pattern matches nothing.
    """
    if pattern is None:
        return F.lit(False)
    return F.lower(_col(column)).like(f"%{pattern.lower()}%")


def chunk_key(*parts: Column | str) -> Column:
    """A repeatable chunk id from what identifies the chunk."""
    return F.sha2(F.concat_ws("|", *(_col(part).cast("string") for part in parts)), 256)
