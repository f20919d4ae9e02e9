"""Fill-in-the-middle: a document's units are cut into prefix, middle and suffix and
written with markers in one of two orders.

A unit is a run of A-Z and a-z or any other single code point. Units are found without
decoding: the UTF-8 bytes of many texts are seen as 64-bit words, and arithmetic on
whole words (eight bytes at a time, no carry between them) marks the high bit of every
byte that ends a unit. ``bitwise_count`` of each word and its running sum rank the
marks; the end of a text's k-th unit is found by a search in the running sum for
the word and a select among the eight bytes of that word. Code points are counted in the
same way, by the bytes that are no continuation bytes.

Texts are cut in Arrow batches, ``SLICE_BYTES`` at a time (or one longer text); nothing
is shuffled.

Defined cases: null is the empty text; empty texts and texts that hold a marker stay
plain; a null ``doc_id`` is hashed as an empty one; repeated rows are cut alike; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import U64, slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of a hundred documents with text: how many are cut, and how many of those begin with the suffix.
CUT, SUFFIX_FIRST = 90, 20
SEED = 1

_HIGH = U64(0x8080808080808080)
_LOW7 = U64(0x7F7F7F7F7F7F7F7F)
_ONES = U64(0x0101010101010101)


def _every(byte: int) -> np.uint64:
    return _ONES * U64(byte)


def _words(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian 64-bit words, padded by zeros (and one word more)."""
    padded = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def _following(words: np.ndarray) -> np.ndarray:
    """Each byte's place takes the byte that follows it."""
    out = words >> U64(8)
    out[:-1] |= words[1:] << U64(56)
    return out


def letters(words: np.ndarray) -> np.ndarray:
    """High bit of every byte that is A-Z or a-z."""
    low = (words | _every(0x20)) & _LOW7
    at_least_a = low + _every(0x80 - ord("a"))
    above_z = low + _every(0x80 - ord("z") - 1)
    return at_least_a & ~above_z & ~words & _HIGH


def continuations(words: np.ndarray) -> np.ndarray:
    """High bit of every byte 10xxxxxx."""
    return words & ~(words << U64(1)) & _HIGH


def unit_ends(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """High bit of every byte that ends a unit: the next byte neither carries on the
    code point nor the run of letters. A text's last byte ends its last unit."""
    letter = letters(words)
    ends = ~(letter & _following(letter)) & ~_following(continuations(words)) & _HIGH
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    np.bitwise_or.at(ends, last >> 3, U64(0x80) << ((last & 7) * 8).astype(np.uint64))
    return ends


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marked: np.ndarray):
        self.marked = marked
        self.before = np.zeros(len(marked) + 1, np.int64)
        np.cumsum(np.bitwise_count(marked), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before the byte positions ``at``."""
        inside = (U64(1) << ((at & 7) * 8).astype(np.uint64)) - U64(1)
        return self.before[at >> 3] + np.bitwise_count(self.marked[at >> 3] & inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte positions of the k-th marks, from 1."""
        word = np.minimum(np.searchsorted(self.before, k, "left") - 1, len(self.marked) - 1)
        left = (k - self.before[word]).astype(np.uint64)
        # Byte i of ``upto`` counts the marks of the word's bytes 0 to i; bytes with fewer than ``left`` come before the mark.
        upto = (self.marked[word] >> U64(7)) * _ONES
        fewer = ~((upto | _HIGH) - left * _ONES) & _HIGH
        return word * 8 + np.bitwise_count(fewer)


def draws(doc_id: object, seed: int = SEED) -> tuple[int, int, int, int]:
    """The four numbers that decide a document's cut and form."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def marked_up(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == PSM:
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The document behind an output; no marker occurs in the parts of one."""
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    one, rest = output[len(first):].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (one, two) if form == PSM else (two, one)
    return prefix + middle + suffix


def cut(data: np.ndarray, offsets: np.ndarray, ids: list, seed: int = SEED) -> Iterator[tuple[int, str, int | None, int | None, bytes]]:
    """(units, form, code points of prefix and of middle, output) of every text."""
    words = _words(data)
    units, points = Marks(unit_ends(words, offsets)), Marks(~continuations(words) & _HIGH)
    first = units.rank(offsets)
    n = np.diff(first)
    drawn = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    ends = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    # Byte positions where prefix and middle end; a part of no units ends where the text starts.
    at = np.where(ends > 0, units.select(np.maximum(first[:-1, None] + ends, 1).ravel()).reshape(ends.shape) + 1, offsets[:-1, None])
    chars = points.rank(np.column_stack([offsets[:-1], at]))
    for i, (a, b, c, z) in enumerate(np.column_stack([offsets[:-1], at, offsets[1:]]).tolist()):
        text = data[a:z].tobytes()
        if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or drawn[i, 2] % 100 >= CUT:
            yield int(n[i]), PLAIN, None, None, text
            continue
        form = SPM if drawn[i, 3] % 100 < SUFFIX_FIRST else PSM
        yield (int(n[i]), form, int(chars[i, 1] - chars[i, 0]), int(chars[i, 2] - chars[i, 1]),
               marked_up(form, text[:b - a], text[b - a:c - a], text[c - a:]))


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output text of every row of
    ``docs`` (doc_id, text), and restored, the text read back from the output."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("doc_id").to_pylist()
            for a, b, data, offsets in slices(batch.column("text")):
                rows = list(cut(data, offsets, column[a:b], seed))
                yield pa.RecordBatch.from_arrays(
                    [ids[a:b], pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                     pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
                     pa.array([r[4] for r in rows], pa.binary()).cast(pa.string(), safe=False),
                     pa.array([restore(r[4], r[1]) for r in rows], pa.binary()).cast(pa.string(), safe=False)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string, restored string")
