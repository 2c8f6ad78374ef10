"""SentencePiece encoding and decoding: segmentations sampled from the piece lattice by forward filtering and backward sampling.

The pieces are a public vocabulary's; a piece's weight is 1 / (1 + rank), with the rank that its score states, to the power
of `sharpness`. Forward sums of path weights are kept for every place of the lattice; a segmentation is drawn from the end
backwards, each piece with the probability that the sums give it, so that whole segmentations have the probability of their
weight. A random number is a hash of seed, row key, place of the chunk in the row and step, so that a row is segmented alike
wherever and with whatever other rows it runs. No piece has a space after another character or a newline, so lattices are
of chunks (spaces with what follows them, or a newline), built once for equal chunks.

A space stands for the vocabulary's space mark; a literal mark, and any character without a piece of its own, is written as
byte pieces. Decoding joins the pieces' bytes and gives the text back exactly.

Defined cases: a null text has null pieces and decodes to null, an empty one has no pieces; a null key is taken as 0 and rows
that share a key and a text are segmented alike; extra columns are dropped. Texts of any length are taken whole, in steps of
STEP bytes: lattices are built over LATTICE bytes of distinct chunks at a time, and a chunk of over LONG bytes (a text may
have no space at all) is walked in windows, with the forward sums alone kept for all of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.llm.kernels import U, column, hash_words, mix, pieces, tidy, weights
from coverloom.llm.util import arrow_batches, ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text of one step, of distinct chunks in one set of lattices, and of a chunk that is walked in windows of WINDOW bytes.
STEP, LATTICE, LONG, WINDOW = 1 << 20, 1 << 16, 1 << 12, 1 << 15
#: Bits of a piece's key that a table looks up first.
SIEVE = 17
#: Places between two rescalings of the forward sums of a long chunk.
RESCALE = 64


def load(path: str = MODEL) -> dict:
    """The vocabulary as arrays, for broadcasting: bytes of each id, ids of the byte pieces, keys of the pieces by length."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    raw, rank, byte_id = [], np.zeros(len(names)), np.zeros(256, np.int64)
    for i, p in enumerate(names):
        if sp.is_byte(i):
            raw.append(bytes([int(p[3:5], 16)]))
            byte_id[raw[-1][0]] = i
        else:
            raw.append(b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace("▁", " ").encode())
            rank[i] = -sp.get_score(i)
    usable = [i for i, p in enumerate(raw) if p and not sp.is_byte(i)]
    ends = np.cumsum([len(p) for p in raw])
    flat = np.frombuffer(b"".join(raw), np.uint8)
    start = ends - np.array([len(p) for p in raw])
    by_length = {}
    for n in sorted({len(raw[i]) for i in usable}):
        ids = np.array([i for i in usable if len(raw[i]) == n])
        key = _keys(flat, start[ids], n)
        order = np.argsort(key)
        assert (np.diff(key[order].astype(object)) > 0).all(), "two pieces have one key"
        by_length[n] = (key[order], ids[order], np.bincount((key >> U(64 - SIEVE)).astype(np.int64), minlength=1 << SIEVE) > 0)
    return {"flat": flat, "start": start, "end": ends, "byte_id": byte_id, "log": -np.log1p(rank), "by_length": by_length}


def _keys(d, at, n: int):
    """Hash of the n bytes at each place."""
    c = weights(n, 23)
    h = np.zeros(len(at), np.uint64)
    for i in range(n):
        h += (d[at + i].astype(np.uint64) + U(1)) * c[i]
    return mix(h)


def _found(d, at, n: int, vocab):
    """(places among `at`, ids) of the pieces of n bytes."""
    key, ids, sieve = vocab["by_length"][n]
    k = _keys(d, at, n)
    i = np.flatnonzero(sieve[(k >> U(64 - SIEVE)).astype(np.int64)])  # few other keys pass
    k = k[i]
    p = np.minimum(np.searchsorted(key, k), len(key) - 1)
    hit = key[p] == k
    return i[hit], ids[p[hit]]


def chunks(d, starts, ends):
    """Begin, end and row of each chunk of the rows [starts, ends) of d."""
    new = np.zeros(len(d) + 1, bool)
    space, line = d == 32, d == 10
    new[1:-1] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    full = np.flatnonzero(ends > starts)
    new[starts[full]] = True
    begin = np.flatnonzero(new[:-1])
    return begin, np.append(begin[1:], len(d)), full[np.searchsorted(starts[full], begin, "right") - 1] if len(full) else begin


class Lattice:
    """Lattices of many chunks of d. Node j of a chunk is the place after its first j bytes."""

    def __init__(self, d, begin, end, vocab, sharpness: float):
        size = end - begin
        order = np.argsort(-size, kind="stable")
        begin, end, size = begin[order], end[order], size[order]
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        # bytes of all chunks, one after another, and one node more for each
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        owner = np.repeat(np.arange(len(size)), size)
        at = np.arange(int(size.sum()))
        self.bytes = b = d[at + (begin - first)[owner]]
        left = (first + size)[owner] - at
        head = (b & 0xC0) != 0x80
        wide = 1 + (b >= 0xC0).astype(np.int64) + (b >= 0xE0) + (b >= 0xF0)
        lengths = [n for n in vocab["by_length"] if n <= (size[0] if len(size) else 0)]
        spans = sorted(set(lengths) | {1, 2, 3, 4})
        col = {n: i for i, n in enumerate(spans)}
        weight = np.full((len(spans), len(b)), -np.inf, np.float32)
        self.code = code = np.full((len(spans), len(b)), -1, np.int32)
        known = np.zeros(len(b), bool)
        for n in lengths:
            i = np.flatnonzero(head & (left >= n))
            hit, piece = _found(b, i, n, vocab)
            i = i[hit]
            code[col[n], i] = piece
            weight[col[n], i] = vocab["log"][piece] * sharpness
            known[i[wide[i] == n]] = True
        i = np.flatnonzero(head & ~known)
        row = np.array([col[x] for x in (1, 2, 3, 4)])[wide[i] - 1]
        code[row, i] = -2  # bytes of one character
        weight[row, i] = (vocab["log"].min() - 1) * sharpness * wide[i]
        # forward sums, for all chunks of at least j bytes at a time
        self.base = first + np.arange(len(size))
        total = np.full(len(b) + len(size), -np.inf, np.float32)
        total[self.base] = 0
        self.spans = np.array(spans)
        self.cum = np.ones((len(total), len(spans)), np.float32)
        alive = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
        for j, k in enumerate(alive, 1):
            use = [i for i, n in enumerate(spans) if n <= j]
            cand = np.empty((len(use), k), np.float32)
            for i in use:
                np.add(total[self.base[:k] + (j - spans[i])], weight[i][first[:k] + (j - spans[i])], out=cand[i])
            most = cand.max(0)
            most[most == -np.inf] = 0
            share = np.exp(cand - most)
            np.cumsum(share, 0, out=share)
            sums = share[-1].copy()
            with np.errstate(divide="ignore"):
                total[self.base[:k] + j] = most + np.log(sums)
            share[share >= sums] = np.inf  # the last possible span takes all that is left
            share /= np.maximum(sums, 1e-30)
            self.cum[self.base[:k] + j, : len(use)] = share.T
        self.first, self.size = first, size

    def sample(self, chunk, salt):
        """Pieces of each occurrence: (how many, codes in order, places of the codes in self.bytes). chunk: which chunk; salt: its random state."""
        chunk = self.rank[chunk]
        j = self.size[chunk].copy()
        live, steps = np.arange(len(chunk)), []
        step = 0
        while len(live):
            step += 1
            u = (mix(salt[live] + U(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> U(11)).astype(np.float64) * 2.0**-53
            row = (self.cum[self.base[chunk[live]] + j[live]] > u[:, None]).argmax(1)
            j[live] -= self.spans[row]
            place = self.first[chunk[live]] + j[live]
            steps.append((live, self.code[row, place], place))
            live = live[j[live] > 0]
        n = np.zeros(len(chunk), np.int64)
        for live, _, _ in steps:
            n[live] += 1
        last = np.cumsum(n)
        codes, places = np.empty(int(n.sum()), np.int32), np.empty(int(n.sum()), np.int64)
        for i, (live, c, p) in enumerate(steps, 1):
            codes[last[live] - i] = c
            places[last[live] - i] = p
        return n, codes, places


def _matches(b, begin: int, end: int, vocab, sharpness: float):
    """(start, bytes, code, log weight) of the pieces that start in [begin, end) of b, by start and bytes; code -2: one character by its bytes."""
    longest = max(vocab["by_length"])
    part = b[begin : min(len(b), end + longest)]
    left = len(part) - np.arange(len(part))
    head = (part & 0xC0) != 0x80
    head[end - begin :] = False
    wide = 1 + (part >= 0xC0).astype(np.int64) + (part >= 0xE0) + (part >= 0xF0)
    known, found = np.zeros(len(part), bool), []
    for n in vocab["by_length"]:
        i = np.flatnonzero(head & (left >= n))
        hit, piece = _found(part, i, n, vocab)
        i = i[hit]
        known[i[wide[i] == n]] = True
        found.append((i, np.full(len(i), n), piece, vocab["log"][piece] * sharpness))
    i = np.flatnonzero(head & ~known)
    found.append((i, wide[i], np.full(len(i), -2), (vocab["log"].min() - 1) * sharpness * wide[i]))
    start, size, code, weight = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((size, start))
    return start[order] + begin, size[order], code[order], weight[order]


def sample_long(b, vocab, sharpness: float, salt):
    """(codes, places) of one long chunk b: the forward sums of all places by windows, then the choice of each place, from the last window back."""
    n, longest = len(b), max(vocab["by_length"])
    log, base = np.full(n + 1, -np.inf, np.float32), np.zeros(n // RESCALE + 1)
    sums = [1.0] + [0.0] * (WINDOW + longest)  # of the places of a window and what its pieces reach, in units of exp(unit)
    unit = 0.0
    for a in range(0, n, WINDOW):
        z = min(n, a + WINDOW)
        start, size, _, weight = _matches(b, a, z, vocab, sharpness)
        edges = np.searchsorted(start, np.arange(a, z + RESCALE, RESCALE))
        start, to, factor = (start - a).tolist(), (start + size - a).tolist(), np.exp(weight).tolist()
        for block, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            s = block * RESCALE
            e = min(s + RESCALE, z - a)
            most = max(sums[s : s + longest + 1])
            sums[s : s + longest + 1] = [v / most for v in sums[s : s + longest + 1]]
            unit += float(np.log(most))
            for i, j, f in zip(start[x:y], to[x:y], factor[x:y]):
                if sums[i]:
                    sums[j] += sums[i] * f
            base[(a + s) // RESCALE] = unit
            with np.errstate(divide="ignore"):
                log[a + s : a + e] = np.log(sums[s:e])
        if z == n:
            base[n // RESCALE] = unit
            log[n] = np.log(sums[n - a])
        sums = sums[z - a : z - a + longest + 1] + [0.0] * WINDOW
    at = lambda i: log[i] + base[i // RESCALE]
    codes, places, j = [], [], n
    for a in range((n - 1) // WINDOW * WINDOW, -1, -WINDOW):
        z = min(n, a + WINDOW)
        start, size, code, weight = _matches(b, max(0, a - longest), z, vocab, sharpness)
        end = start + size
        use = (end > a) & (end <= z) & np.isfinite(log[start])
        start, size, code, weight, end = (x[use] for x in (start, size, code, weight, end))
        order = np.lexsort((size, end))
        start, size, code, weight, end = (x[order] for x in (start, size, code, weight, end))
        share = np.cumsum(np.exp(at(start) + weight - at(end)))
        last = np.searchsorted(end, np.arange(a + 1, z + 1), "right")
        first = np.concatenate(([0], last[:-1]))
        low = np.where(first > 0, share[np.maximum(first, 1) - 1], 0.0)
        u = (mix(salt ^ mix(np.arange(a + 1, z + 1).astype(np.uint64) * U(0x9E3779B97F4A7C15))) >> U(11)).astype(np.float64) * 2.0**-53
        pick = np.searchsorted(share, low + u * (share[np.maximum(last, 1) - 1] - low), "right")
        pick = np.clip(pick, first, last - 1).tolist()
        size, code, start = size.tolist(), code.tolist(), start.tolist()
        while j > a:
            i = pick[j - a - 1]
            codes.append(code[i])
            places.append(start[i])
            j -= size[i]
    return np.array(codes[::-1], np.int64), np.array(places[::-1], np.int64)


def _spelled(codes, at, b, vocab):
    """(ids, ids of each code): codes of -2 become the byte pieces of the character at their place in b."""
    lead = b[at]
    width = np.where(codes >= 0, 1, 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0))
    ids = np.repeat(codes, width).astype(np.int32)
    spell = np.flatnonzero(ids == -2)
    source = np.repeat(at, width)[spell] + (spell - np.repeat(np.cumsum(width) - width, width)[spell])
    ids[spell] = vocab["byte_id"][b[source]]
    return ids, width


def _encode_chunks(d, begin, end, salt, vocab, sharpness: float):
    """(ids, ids of each chunk) of the chunks [begin, end) of d, in order."""
    size, parts = end - begin, []
    for i in np.flatnonzero(size > LONG):
        b = d[begin[i] : end[i]]
        ids, _ = _spelled(*sample_long(b, vocab, sharpness, salt[i]), b, vocab)
        parts.append((np.array([i]), np.array([len(ids)]), ids))
    short = np.flatnonzero(size <= LONG)
    _, some, which = np.unique(hash_words(d, begin[short], end[short], 31), return_index=True, return_inverse=True)
    some = short[some]
    order = np.argsort(size[some], kind="stable")
    group = np.empty(len(some), np.int64)
    group[order] = (np.cumsum(size[some[order]]) - 1) // LATTICE
    for g in range(int(group.max()) + 1 if len(some) else 0):
        own = np.flatnonzero(group == g)
        lattice = Lattice(d, begin[some[own]], end[some[own]], vocab, sharpness)
        place = np.full(len(some), -1)
        place[own] = np.arange(len(own))
        here = np.flatnonzero(place[which] >= 0)
        for x in range(0, len(here), LATTICE):
            some_here = here[x : x + LATTICE]
            n, codes, at = lattice.sample(place[which[some_here]], salt[short[some_here]])
            ids, width = _spelled(codes, at, lattice.bytes, vocab)
            parts.append((short[some_here], np.add.reduceat(width, np.cumsum(n) - n), ids))
    per = np.zeros(len(begin), np.int64)
    for chunk, n, _ in parts:
        per[chunk] = n
    first, out = np.cumsum(per) - per, np.empty(int(per.sum()), np.int32)
    for chunk, n, ids in parts:
        out[np.repeat(first[chunk] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
    return out, per


def encode_rows(data, starts, ends, keys, vocab, seed: int, sharpness: float):
    """For runs of rows: (i, j, ids, ids of each row)."""
    for i, j in pieces(starts, ends, STEP):
        a = starts[i]
        d = data[a : ends[j - 1]]
        begin, end, row = chunks(d, starts[i:j] - a, ends[i:j] - a) if len(d) else (np.zeros(0, np.int64),) * 3
        place = np.arange(len(row)) - np.searchsorted(row, row)
        salt = mix(mix(keys[i:j] + U(seed))[row] + place.astype(np.uint64) * U(0xD1342543DE82EF95))
        out, total, x = [], np.zeros(j - i, np.int64), 0
        while x < len(row):  # more than one step only if one row is longer than a step
            y = max(x + 1, int(np.searchsorted(end, begin[x] + STEP, "right")))
            ids, per = _encode_chunks(d, begin[x:y], end[x:y], salt[x:y], vocab, sharpness)
            out.append(ids)
            total += np.bincount(row[x:y], per, j - i).astype(np.int64)
            x = y
        yield i, j, np.concatenate(out) if out else np.zeros(0, np.int32), total


def decode_ids(ids, vocab):
    """The bytes of a run of ids."""
    start, size = vocab["start"][ids], (vocab["end"] - vocab["start"])[ids]
    return vocab["flat"][np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)], size


def encode(docs: DataFrame, path: str = MODEL, key: str = "doc_id", text: str = "text", seed: int = 1, sharpness: float = 0.3) -> DataFrame:
    """doc_id, ids (array of int; null for a null text) and lossless (whether decoding the ids gives the text's bytes) for every row of docs."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(load(path))

    def run(batches):
        vocab = shared.value
        for b in batches:
            data, starts, ends, valid = column(b, "text")
            keys = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i, j, ids, n in encode_rows(data, starts, ends, keys, vocab, seed, sharpness):
                back, size = decode_ids(ids, vocab)
                row_of = np.repeat(np.arange(j - i), n)
                total = np.bincount(row_of, size, j - i).astype(np.int64)
                whole = data[starts[i] : ends[j - 1]]
                if len(back) == len(whole) and (back == whole).all():
                    same = total == ends[i:j] - starts[i:j]
                else:
                    at = np.concatenate(([0], np.cumsum(total)))
                    same = np.array([np.array_equal(back[at[x] : at[x + 1]], data[starts[i + x] : ends[i + x]]) for x in range(j - i)], bool)
                offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                off = pa.array(offsets, mask=np.append(~valid[i:j], False))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.ListArray.from_arrays(off, pa.array(ids.astype(np.int32))), pa.array(same)], ["doc_id", "ids", "lossless"])

    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(tidy(run), "doc_id long, ids array<int>, lossless boolean")


def decode(encoded: DataFrame, path: str = MODEL, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and text of rows of piece ids."""
    spark: SparkSession = encoded.sparkSession
    shared = spark.sparkContext.broadcast(load(path))

    def run(batches):
        vocab = shared.value
        for b in batches:
            lists = b.column("ids")
            out = [None if x is None else decode_ids(np.array(x, np.int64), vocab)[0].tobytes().decode() for x in lists.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(tidy(run), "doc_id long, text string")


ship(__name__)
