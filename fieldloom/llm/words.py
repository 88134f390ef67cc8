"""Words of whole texts as numpy arrays, without a Python object per word.

A batch of texts is one run of UTF-8 bytes (Arrow's own layout). A word is a maximal run of
bytes that belong to a word; two tables of 256 entries say which bytes do and how bytes are
folded. Each word gets a 64-bit hash: a polynomial over random byte codes, computed by prefix
sums, then mixed. Equal words have equal hashes; different words share one with a chance of
about 2^-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text taken at once; a longer text is taken alone.
CHUNK = 1 << 19

_BYTES = np.arange(256)
#: `[\x20\x09-\x0D]` parts words.
BETWEEN_SPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
#: `[0-9A-Za-z]` and every byte of a character beyond ASCII make words.
ALPHANUMERIC = (
    ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
)
_CODES = np.random.default_rng(20231).integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
#: Random codes of bytes as they are, and with A-Z as a-z.
EXACT = _CODES
FOLDED = _CODES.copy()
FOLDED[65:91] = _CODES[97:123]

_BASE = U(0x9E3779B97F4A7C15)
_BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class _Powers:
    """1, b, b^2, ... and the inverses, grown when a longer run needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.concatenate([[U(1)], np.full(n - 1, b, U)])) for b in (_BASE, _BASE_INVERSE))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Words(NamedTuple):
    """The words of several texts, one text after the other."""

    hashes: np.ndarray  # of each word
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]
    starts: np.ndarray  # first byte of each word, within the run of bytes
    ends: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, codes: np.ndarray) -> Words:
    """The words of the texts that lie in ``data`` between neighbouring ``offsets``."""
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = member[data]
    first = np.zeros(n + 2, bool)
    first[offsets + 1] = True  # a text starts here, so a word ends here
    begins = inside & (~np.roll(inside, 1) | first)
    starts = np.flatnonzero(begins) - 1
    stops = ~inside & np.roll(inside, 1)
    stops |= first & inside & np.roll(inside, 1)
    ends = np.flatnonzero(stops) - 1
    up, down = _POWERS.get(n + 1)
    sums = np.zeros(n + 1, U)
    np.cumsum(codes[data] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = texts.type in (pa.large_string(), pa.large_binary())
    kind = np.int64 if wide else np.int32
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def chunks(texts: pa.Array, member: np.ndarray, codes: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int, Words, np.ndarray]]:
    """(first row, row after the last, their words, their bytes), about ``size`` bytes at a time."""
    data, offsets = text_bytes(texts)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        part = offsets[row : stop + 1]
        yield row, stop, words_of(data, part, member, codes), data[part[0] : part[-1]]
        row = stop


def rolling(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` neighbouring words: element i is of words i to i+length-1."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U)
    up, down = _POWERS.get(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, U)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * down[:n] + U(length))


def prefix_hashes(data: np.ndarray, words: Words, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the first ``length`` bytes, number of the word) of each word that is so long. A
    prefix never has the hash of a whole word."""
    up, down = _POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(codes[data] * up[: len(data)], out=sums[1:])
    which = np.flatnonzero(words.ends - words.starts >= length)
    at = words.starts[which]
    return mix((sums[at + length] - sums[at]) * down[at] + U(length)) ^ U(0x5BD1E9955BD1E995), which
