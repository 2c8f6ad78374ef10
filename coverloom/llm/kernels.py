"""NumPy kernels over the bytes of Arrow string columns. They run in executors and depend on numpy and pyarrow alone."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa

from coverloom.llm.util import ship

U = np.uint64
#: Bytes of text that one step of a kernel works on; longer texts are taken whole where words are needed.
PIECE = 1 << 20
#: Bytes of words that are hashed at once.
BLOCK = 1 << 16


def column(batch, name: str):
    """(bytes, starts, ends, valid) of a string or binary column; a null has no bytes."""
    col = batch.column(batch.schema.get_field_index(name))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n, kind = len(col), np.int64 if col.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, kind)[col.offset : col.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    valid = np.ones(n, bool) if col.null_count == 0 else ~np.asarray(col.is_null())
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    starts, ends = at[:-1].copy(), at[1:].copy()
    ends[~valid] = starts[~valid]
    return data, starts, ends, valid


def tidy(run):
    """run (over Arrow batches), after which the worker, which Spark keeps for later tasks, gives back the memory that it holds unused."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return tidied


def pieces(starts, ends, size: int = PIECE):
    """Ranges of rows of about `size` bytes together."""
    i, n = 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + size)))
        yield i, min(j, n)
        i = min(j, n)


def byte_set(*ranges) -> np.ndarray:
    """Boolean table of 256 bytes, true in the given inclusive ranges."""
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


def white_words() -> np.ndarray:
    """Bytes of words between ASCII white space."""
    return ~byte_set((0x20, 0x20), (0x09, 0x0D))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix(x):
    """A 64-bit finalizer; works on a copy."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def weights(n: int, seed: int, start: int = 0) -> np.ndarray:
    """n odd 64-bit multipliers of one stream for a seed, from the place `start` on."""
    return mix((np.arange(start, start + n, dtype=np.uint64) + U(seed * 1_000_003 + 1)) * U(0x9E3779B97F4A7C15)) | U(1)


def split_words(d, starts, ends, table):
    """Words of rows in d: (first byte, end, row); rows are [starts, ends) in d and no word crosses a row."""
    m = table[d] if len(d) else np.zeros(0, bool)
    before = np.zeros(len(d), bool)
    before[1:] = m[:-1]
    after = np.zeros(len(d), bool)
    after[:-1] = m[1:]
    full = np.flatnonzero(ends > starts)
    before[starts[full]] = False
    after[ends[full] - 1] = False
    first, last = np.flatnonzero(m & ~before), np.flatnonzero(m & ~after) + 1
    return first, last, full[np.searchsorted(starts[full], first, "right") - 1] if len(full) else np.zeros(0, np.int64)


def hash_words(d, first, last, seed: int = 1):
    """64-bit hash of each word d[first:last], by BLOCK bytes at a time, so that memory follows the number of words alone."""
    n = last - first
    out = np.zeros(len(first), np.uint64)
    long = n > BLOCK
    for i in np.flatnonzero(long):
        for a in range(0, int(n[i]), BLOCK):
            part = d[first[i] + a : min(first[i] + a + BLOCK, last[i])]
            out[i : i + 1] += ((part.astype(np.uint64) + U(1)) * weights(len(part), seed, a)).sum(dtype=np.uint64)
    own = np.flatnonzero(~long & (n > 0))
    if len(own):
        multipliers = weights(int(n[own].max()), seed)
        ends = np.cumsum(n[own])
        cuts = np.searchsorted(ends, np.arange(BLOCK, ends[-1], BLOCK))
        for part in np.split(own, np.unique(cuts)):
            if not len(part):
                continue
            size = n[part]
            start = np.cumsum(size) - size
            within = np.arange(int(size.sum()))
            at = within + np.repeat(first[part] - start, size)
            within -= np.repeat(start, size)
            out[part] = np.add.reduceat((d[at].astype(np.uint64) + U(1)) * multipliers[within], start)
    return mix(out + n.astype(np.uint64))


def grams(h, k: int, seed: int = 7):
    """Hash of each run of k hashes in h (none if h is shorter)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    c = weights(k, seed)
    out = h[: len(h) - k + 1] * c[0]
    for i in range(1, k):
        out += h[i : len(h) - k + 1 + i] * c[i]
    return mix(out)


def shingle_sets(batch, text: str, k: int = 5):
    """For each row: the sorted distinct hashes of its k-word shingles, A-Z lower-cased; fewer words, but some, give one."""
    data, starts, ends, _ = column(batch, text)
    lower, table, c = lower_table(), white_words(), weights(k, 11)
    for i, j in pieces(starts, ends):
        a = starts[i]
        d = lower[data[a : ends[j - 1]]]
        first, last, row = split_words(d, starts[i:j] - a, ends[i:j] - a, table)
        h = hash_words(d, first, last)
        g = grams(h, k)
        bounds = np.searchsorted(row, np.arange(j - i + 1))
        for x in range(j - i):
            p, q = int(bounds[x]), int(bounds[x + 1])
            if q - p >= k:
                s = np.sort(g[p : q - k + 1])
                s = s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) > 1 else s
            elif q > p:
                s = mix(np.array([(h[p:q] * c[: q - p]).sum(dtype=np.uint64) + U(q - p)], np.uint64))
            else:
                s = np.zeros(0, np.uint64)
            yield i + x, s


def maybe_in(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in a Bloom filter of 64-bit words: two bits of one word each."""
    word = bits[(keys >> U(12)) % U(len(bits))]
    mask = (U(1) << (keys & U(63))) | (U(1) << ((keys >> U(6)) & U(63)))
    return (word & mask) == mask


ship(__name__)
