"""Words of whole Arrow text columns as 64-bit hashes, computed with numpy.

Texts are walked in chunks of bounded size, so memory does not grow with the rows of a
batch, and of one long text only its word hashes are held (8 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21
# Powers for the characters of a word; longer words use them again, and their length
# is hashed too.
_POWERS = 4096


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of the public-domain splitmix64 generator: a bijection on 64 bits."""
    h = np.array(h, dtype=np.uint64)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def unmix(h: np.ndarray) -> np.ndarray:
    """What :func:`mix` made ``h`` of."""
    h = np.array(h, dtype=np.uint64)
    h ^= (h >> np.uint64(31)) ^ (h >> np.uint64(62))
    h *= np.uint64(pow(0x94D049BB133111EB, -1, 2**64))
    h ^= (h >> np.uint64(27)) ^ (h >> np.uint64(54))
    h *= np.uint64(pow(0xBF58476D1CE4E5B9, -1, 2**64))
    h ^= (h >> np.uint64(30)) ^ (h >> np.uint64(60))
    return h


def seeded(count: int, seed: int) -> np.ndarray:
    """``count`` fixed pseudo-random words of 64 bits."""
    start = (seed * 0x9E3779B97F4A7C15 + 1) % 2**64
    steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(start))


class WordHasher:
    """Hashes of the words of texts, ASCII letters folded to lower case.

    ``letters_only=False``: words are runs of anything but space and U+0009-U+000D.
    ``letters_only=True``: runs of ASCII letters, digits and all non-ASCII characters.
    """

    def __init__(self, letters_only: bool = False):
        code = np.arange(256)
        lowered = np.where((code >= 65) & (code <= 90), code + 32, code)
        self.value = seeded(256, 11)[lowered]
        if letters_only:
            alnum = ((code >= 48) & (code <= 57)) | ((lowered >= 97) & (lowered <= 122))
            self.inside = alnum | (code >= 128)
        else:
            self.inside = ~((code == 32) | ((code >= 9) & (code <= 13)))
        power = np.cumprod(np.full(_POWERS, 0x2545F4914F6CDD1D, dtype=np.uint64))
        self.power = power | np.uint64(1)

    def bytes(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of ``data`` and the byte where each word starts; no word spans
        a position in ``cuts``."""
        inside = self.inside[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        at = cuts[cuts < len(data)]
        first[at] = inside[at]
        starts = np.flatnonzero(first)
        if not len(starts):
            return np.empty(0, np.uint64), starts
        compact = np.cumsum(inside, dtype=np.int32)[starts] - 1
        values = self.value[data[inside]]
        lengths = np.diff(compact, append=np.int32(len(values)))
        place = np.arange(len(values), dtype=np.int32)
        place -= np.repeat(compact, lengths)
        values *= self.power[place & (_POWERS - 1)]
        hashes = np.add.reduceat(values, compact)
        hashes += lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix(hashes), starts

    def _long(self, data: np.ndarray) -> np.ndarray:
        """Word hashes of one long text, chunk by chunk, cut between words."""
        parts, start = [], 0
        while start < len(data):
            end = min(start + CHUNK_BYTES, len(data))
            while end < len(data):
                gaps = np.flatnonzero(~self.inside[data[start:end]])
                if len(gaps):
                    end = start + int(gaps[-1]) + 1
                    break
                end = min(end + CHUNK_BYTES, len(data))
            parts.append(self.bytes(data[start:end], np.zeros(1, np.int64))[0])
            start = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(row, hashes, first)`` for runs of rows from ``row`` on: text ``row + i`` has
        the words ``hashes[first[i]:first[i + 1]]``. Null texts have none."""
        data, offsets = text_bytes(column)
        row, rows = 0, len(offsets) - 1
        while row < rows:
            end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
            if end <= row:
                hashes = self._long(data[offsets[row] : offsets[row + 1]])
                yield row, hashes, np.array([0, len(hashes)])
                row += 1
                continue
            cuts = offsets[row : end + 1] - offsets[row]
            hashes, starts = self.bytes(data[offsets[row] : offsets[end]], cuts)
            yield row, hashes, np.searchsorted(starts, cuts)
            row = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not data.size:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words of one text; with fewer
    words, of the whole sequence; without words, none."""
    if not len(words):
        return words
    factors = seeded(size, 23) | np.uint64(1)
    width = min(size, len(words))
    runs = len(words) - width + 1
    total = np.full(runs, width, dtype=np.uint64)
    for i in range(width):
        total += words[i : i + runs] * factors[i]
    return np.unique(mix(total))
