"""Words and shingles of whole texts as 64-bit hashes, in numpy, a few megabytes at a time.

A word is a maximal run of bytes other than space and \\x09-\\x0D. Hashes are
the same in every process: a word's bytes are mapped through a fixed random
table, summed with powers of an odd base modulo 2**64 and mixed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: All ASCII but letters and digits: what is left are words without punctuation.
PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
CHUNK_BYTES = 1 << 21
_GROUP_BYTES = 1 << 20
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], U))[0])


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 16), base, U)
        p[0] = 1
        have = np.cumprod(p, dtype=U)
        if n <= 2 * _GROUP_BYTES:
            _powers[base] = have
    return have[:n]


def utf8(column: pa.Array) -> list[bytes | None]:
    """The column's texts as UTF-8 bytes."""
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


def chunks(texts: list[bytes | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``size`` bytes together; a longer text is a range of its own."""
    first = total = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if total and total + n > size:
            yield first, i
            first, total = i, 0
        total += n + 1
    if first < len(texts):
        yield first, len(texts)


class Words:
    """The words of some texts: byte bounds in ``data``, and each text's first word in ``offsets``."""

    def __init__(self, texts: list[bytes | None], lower: bool = False, space: np.ndarray = _SPACE):
        raw = b"\n".join([t or b"" for t in texts]) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        self.data = _LOWER[data] if lower else data
        edge = np.flatnonzero(np.diff(space[data].astype(np.int8), prepend=np.int8(1)))
        self.starts, self.ends = edge[::2], edge[1::2]
        lengths = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
        bounds = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.offsets = np.searchsorted(self.starts, bounds)
        self.text_bounds = bounds

    def hashes(self, ends: np.ndarray | None = None) -> np.ndarray:
        """A hash of each word, or of its part before ``ends``."""
        ends = self.ends if ends is None else ends
        out = np.empty(len(self.starts), U)
        i, n = 0, len(self.starts)
        while i < n:
            at = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, at + _GROUP_BYTES, "right")))
            size = int(self.ends[j - 1] - at)
            total = np.empty(size + 1, U)
            total[0] = 0
            np.cumsum(_TABLE[self.data[at:at + size]] * _power(_BASE, size), out=total[1:])
            s, e = self.starts[i:j] - at, ends[i:j] - at
            out[i:j] = mix((total[e] - total[s]) * _power(_INVERSE, size)[s] + (e - s).astype(U))
            i = j
        return out


def fold(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive values."""
    if len(h) < n:
        return np.empty(0, U)
    out = np.zeros(len(h) - n + 1, U)
    for k in range(n):
        out = out * U(_BASE) + h[k:len(h) - n + 1 + k]
    return mix(out)


def running(h: np.ndarray) -> np.ndarray:
    """Running sums of ``h`` from which ``span`` takes the hash of any stretch."""
    return np.concatenate((np.zeros(1, U), np.cumsum(h * _power(_BASE, len(h)), dtype=U)))


def span(total: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the values from ``a`` to before ``b``, the same wherever they stand."""
    return (total[b] - total[a]) * _power(_INVERSE, len(total))[a]


def sequence_hash(h: np.ndarray, salt: int = 0) -> int:
    """Hash of a whole sequence of values, its length included."""
    total = np.sum(mix(h ^ U(salt)) * _power(_BASE, len(h)), dtype=U) if len(h) else U(0)
    return mix_int(int(total) + 0x5851F42D4C957F2D * (len(h) + 1))


def shingle_sets(texts: list[bytes | None], n: int, lower: bool = True) -> Iterator[np.ndarray]:
    """Each text's distinct ``n``-word shingles, ascending; with fewer words the whole sequence as one."""
    for a, b in chunks(texts):
        w = Words(texts[a:b], lower)
        h = w.hashes()
        s = fold(h, n)
        for lo, hi in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist()):
            if hi - lo >= n:
                yield np.unique(s[lo:hi - n + 1])
            elif hi > lo:
                yield np.array([sequence_hash(h[lo:hi], 1)], U)
            else:
                yield np.empty(0, U)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def doc_batches(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, utf8(batch.column(column))
