"""Words as the operators of this package see them, as SQL expressions and as numpy hashes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates words.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
LINES = "\n"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MEMO_ENTRIES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

# Texts are hashed in portions of about so many bytes; words of more than _LONG one by one.
_BYTES_AT_ONCE = 1 << 21
_LONG = 256
# The low 0 to 8 bytes of an integer.
_LOW = np.array([(1 << 8 * count) - 1 for count in range(9)], np.uint64)


def lower_ascii(text: Column) -> Column:
    """``A-Z`` to lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """Words of a text as an array of strings; no text has no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda word: word != "")


class _Memo(dict):
    """64-bit hashes of words. Forgets all when it is full, so that its memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hasher():
    """A function from the UTF-8 bytes of a text to the words and their hashes.

    ``bytes.split`` and ``bytes.lower`` know just the ASCII white space and letters that are asked for.
    """
    known = _Memo()

    def hashes(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    return hashes


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """Of each text (UTF-8 bytes) the 64-bit hashes of its words, ``A-Z`` in lower case; a null has no words.

    Equal words have equal hashes, which are others than those of :func:`word_hasher`. Words are hashed side by side, eight
    bytes at a time: with a large vocabulary a table of known words costs several times that.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    portion = (np.cumsum(sizes) - sizes) // _BYTES_AT_ONCE
    for start, end in pairwise([0, *(np.flatnonzero(np.diff(portion)) + 1).tolist(), len(texts)]):
        yield from _portion_hashes(texts.slice(start, end - start))


def _portion_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    words = lists.flatten()
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw = np.zeros(offsets[-1] + 8, np.uint8)
    raw[: offsets[-1]] = np.frombuffer(data or b"", np.uint8)[: offsets[-1]]
    # Separators at either end of a text leave an empty word.
    lengths = np.diff(offsets)
    real = lengths > 0
    hashes = _bytes_hashes(raw, offsets[:-1][real], lengths[real])
    ends = np.concatenate([[0], np.cumsum(real)])[np.concatenate([[0], np.cumsum(counts)])]
    return (hashes[start:end] for start, end in pairwise(ends.tolist()))


def _bytes_hashes(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of parts of ``raw``, which has eight bytes more than the last part."""
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    hashes = mixed(mixed(lengths.astype(np.uint64) * _ODD) + (eight[starts] & _LOW[np.minimum(lengths, 8)]))
    rest, at = np.flatnonzero((lengths > 8) & (lengths <= _LONG)), 8
    while len(rest):
        left = lengths[rest] - at
        hashes[rest] = mixed(hashes[rest] + (eight[starts[rest] + at] & _LOW[np.minimum(left, 8)]))
        rest, at = rest[left > 8], at + 8
    for place in np.flatnonzero(lengths > _LONG).tolist():
        hashes[place] = xxhash.xxh3_64_intdigest(raw[starts[place] : starts[place] + lengths[place]].tobytes())
    return hashes


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive words: empty if there are fewer."""
    count = len(words) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for place in range(length):
        total = total * _ODD + words[place : place + count]
    return mixed(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; for arrays as short as a text ``np.unique`` takes several times as long."""
    values = np.sort(values)
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def shingle_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``length`` words; fewer words are one run, none is none."""
    if not len(words):
        return np.empty(0, np.uint64)
    if len(words) < length:
        # A short sequence must not equal the run of another length.
        return run_hashes(words, len(words)) ^ np.uint64(len(words))
    return distinct(run_hashes(words, length))
