"""Texts of Arrow batches as flat arrays: bytes, words and their hashes, without a Python object per word."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Words of letters, digits and whatever is not ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-case text.
_IS_TEXT = np.zeros(256, dtype=bool)
_IS_TEXT[48:58] = _IS_TEXT[97:123] = _IS_TEXT[128:] = True

# Words between ASCII spaces: [^\x20\x09-\x0D]+.
_IS_SPACED = np.ones(256, dtype=bool)
_IS_SPACED[9:14] = _IS_SPACED[32] = False

# An odd factor and its inverse modulo 2^64, for prefix hashes that any word can be cut out of.
_FACTOR = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of unsigned 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def seeds(name: str, n: int) -> np.ndarray:
    """``n`` unsigned 64-bit constants that depend on the name alone."""
    start = np.uint64(int.from_bytes(name.encode()[:8].ljust(8, b"."), "big"))
    with np.errstate(over="ignore"):
        return mixed(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_FACTOR))


_powers: dict[int, np.ndarray] = {}


def _powers_of(factor: int, n: int) -> np.ndarray:
    have = _powers.get(factor)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES), factor, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 4 * SLICE_BYTES:
            _powers[factor] = have
    return have[:n]


@dataclass
class Texts:
    """Lower-cased bytes of some texts one after the other; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words in order: bytes ``starts`` to ``ends``, 64-bit ``hashes``; text ``i`` has ``bounds[i]`` to ``bounds[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row begins; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = binary.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[binary.offset : binary.offset + len(binary) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)), bounds


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES, lower: bool = True) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in runs of rows with about ``limit`` bytes of text at most, so memory depends on the longest text only."""
    data, bounds = flat(batch.column(text))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(bounds, bounds[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        part = data[bounds[begin] : bounds[end]]
        yield batch.slice(begin, end - begin), Texts(_LOWER[part] if lower else part, bounds[begin : end + 1] - bounds[begin])
        begin = end


def _words(texts: Texts, inside: np.ndarray) -> Words:
    data, offsets = texts.data, texts.offsets
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64))
    mask = inside[data]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    filled = offsets[:-1][np.diff(offsets) > 0]
    first[filled] = mask[filled]
    closed = offsets[1:][np.diff(offsets) > 0] - 1
    last[closed] = mask[closed]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers_of(_FACTOR, len(data)), out=prefix[1:])
    hashes = mixed((prefix[ends] - prefix[starts]) * _powers_of(_INVERSE, len(data))[starts])
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def text_words(texts: Texts) -> Words:
    """Runs of letters, digits and other than ASCII."""
    return _words(texts, _IS_TEXT)


def spaced_words(texts: Texts) -> Words:
    """Runs between ASCII spaces."""
    return _words(texts, _IS_SPACED)


def heads(texts: Texts, words: Words, letters: int) -> np.ndarray:
    """A hash of the first ``letters`` code points of each word, 0 for words that are no longer than that.

    It never equals the hash of a word with the same letters but by chance.
    """
    if not len(words.starts):
        return np.zeros(0, dtype=np.uint64)
    leads = np.flatnonzero((texts.data & 0xC0) != 0x80)
    at = np.searchsorted(leads, words.starts) + letters
    ends = np.append(leads, len(texts.data))[np.minimum(at, len(leads))]
    longer = ends < words.ends
    prefix = np.zeros(len(texts.data) + 1, dtype=np.uint64)
    np.cumsum((texts.data.astype(np.uint64) + np.uint64(1)) * _powers_of(_FACTOR, len(texts.data)), out=prefix[1:])
    cut = mixed((prefix[np.where(longer, ends, words.ends)] - prefix[words.starts]) * _powers_of(_INVERSE, len(texts.data))[words.starts])
    return np.where(longer, mixed(cut ^ np.uint64(_FACTOR)), np.uint64(0))


def runs_of(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` values, by its first place."""
    n = max(0, len(hashes) - length + 1)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        total = (total + hashes[i : i + n]) * np.uint64(_FACTOR)
    return mixed(total)


def runs_at(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The same hash of the runs that begin at some places only."""
    total = np.zeros(len(at), dtype=np.uint64)
    for i in range(length):
        total = (total + hashes[at + i]) * np.uint64(_FACTOR)
    return mixed(total)


def whole_runs(bounds: np.ndarray, length: int) -> np.ndarray:
    """The places where a run of ``length`` words starts that ends within its text."""
    if bounds[-1] < length:
        return np.zeros(0, dtype=np.int64)
    inside = np.ones(bounds[-1], dtype=bool)
    for back in range(1, length):
        at = bounds[1:] - back
        inside[at[at >= bounds[:-1]]] = False
    return np.flatnonzero(inside)
