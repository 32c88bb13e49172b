"""Texts as numpy arrays: words, hashes and windows of whole Arrow batches without a row loop.

Words are maximal runs without the bytes 0x20 and 0x09-0x0D (all ASCII, so byte positions in
UTF-8 are safe). Hashes are 64-bit polynomials followed by a bit mixer. Arrays are cut into blocks
so that the working memory of a task does not depend on the length of a text or a batch beyond
the text itself.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 19
LONG_WORD = 512
U64 = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i <= n at least (bases are odd, hence invertible).

    A worker keeps one table a base, the longest one asked for up to 4 blocks."""
    if base in _POWERS and n < len(_POWERS[base][0]):
        return _POWERS[base]
    size = 1 << max(10, int(n).bit_length())
    made = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(size, b, U64)
        p[0] = 1
        made.append(np.multiply.accumulate(p))
    if size <= 4 * BLOCK:
        _POWERS[base] = made[0], made[1]
    return made[0], made[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer: every input bit reaches every output bit."""
    h = h ^ (h >> U64(31))
    h *= U64(0x7FB5D329728EA185)
    h ^= h >> U64(27)
    h *= U64(0x81DADEF4BC2DD44D)
    h ^= h >> U64(33)
    return h


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def row_slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20):
    """Cut a batch into runs of rows of about ``most`` text bytes (one row at least). After the batch
    the worker gives Arrow's free memory back, since workers are kept for later stages."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run, first = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if run and run + n > most:
            yield batch.slice(first, i - first)
            first, run = i, 0
        run += n
    if batch.num_rows > first:
        yield batch.slice(first)
    pa.default_memory_pool().release_unused()


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and per text the index of its first word (n + 1)."""
    word = (buf != 32) & ((buf < 9) | (buf > 13))
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(buf))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hash of each byte span; spans are sorted and do not overlap."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = powers(BASES[lane], hi - lo + 1)
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum((buf[lo:hi].astype(U64) + U64(1)) * up[: hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(U64)
        i = j
    return mix(out)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hash of each byte span, for telling words apart: eight bytes at a time through the mixer,
    spans above LONG_WORD bytes by BLAKE2. A polynomial modulo 2^64, as in ``span_hashes``, has equal values
    for whole families of texts over two letters; only chance makes these meet."""
    n = (ends - starts).astype(np.int64)
    out = mix(n.astype(U64) + U64(BASES[lane]))
    eight = np.ndarray(len(buf) + 1, "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))
    plain = np.flatnonzero((n > 0) & (n <= LONG_WORD))
    g = 0
    while len(plain):
        rest = n[plain] - g
        group = eight[starts[plain] + g]
        cut = rest < 8
        group[cut] &= (U64(1) << (U64(8) * rest[cut].astype(U64))) - U64(1)
        out[plain] = mix(out[plain] * U64(BASES[2]) ^ group)
        plain = plain[rest > 8]
        g += 8
    for i in np.flatnonzero(n > LONG_WORD).tolist():
        out[i] = int.from_bytes(blake2b(buf[starts[i]: ends[i]].tobytes(), digest_size=8, salt=bytes([lane])).digest(), "little")
    return out


def window_hashes(values: np.ndarray, k: int, lane: int = 1) -> np.ndarray:
    """Hash of each run of k consecutive values (n - k + 1 of them), in blocks."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.empty(n, U64)
    up, down = powers(BASES[lane], min(n, BLOCK) + k + 1)
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        part = values[a: b + k - 1].astype(U64, copy=False)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum((part + U64(1)) * up[: len(part)], out=sums[1:])
        out[a:b] = (sums[k: k + b - a] - sums[: b - a]) * down[: b - a]
    return mix(out)


def owners(bounds: np.ndarray) -> np.ndarray:
    """Index of the text for each unit, from the bounds of the texts."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values by doubling (n - width + 1 of them)."""
    best, have = values, 1
    while have * 2 <= width:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    rest = width - have
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring bounds; 0 for empty segments."""
    sums = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]
