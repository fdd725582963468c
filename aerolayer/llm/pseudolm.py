"""Masked pseudo-likelihood: a bidirectional window network and the whole corpus' contexts score documents.

Two things are gathered over all documents.  First, words fall into hash buckets, and buckets into CLASSES
classes of about equal mass (frequent buckets alone); the network reads the classes of the two words on each
side of a masked word and predicts its class, and so, by the bucket's share of its class, the word itself.  It
is trained in numpy on the counts of all class contexts of the corpus.  Second, every pair of neighbours
(left word, right word) has the words that stand between it anywhere in the corpus counted, in tables that
grow with the corpus and are never gathered in one place.  The network's distribution is the prior of each
such context, worth PRIOR words, and the counts update it:

    p(word | both sides) = (c + PRIOR * p_network(word | both sides)) / (n + PRIOR)

where n words have been seen between these neighbours elsewhere, c of them this one: the masked word itself is
not counted.  Neighbours are told apart by CONTEXT_BITS of a hash and those of their part of the tables, words
between equal neighbours by WORD_BITS.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, release, table

BUCKETS = 1 << 18
CLASSES, OUTER = 32, 8
#: Class ids 0 to CLASSES-1 are words; beyond the text's ends there is one more class on either side.
INNER_IDS, OUTER_IDS = CLASSES + 1, OUTER + 1
CELLS = OUTER_IDS * INNER_IDS * INNER_IDS * OUTER_IDS * CLASSES
DIM, EPOCHS, BATCH, SEED = 24, 8, 4096, 5
#: Words that the network's prediction counts for; words of the corpus in a part of the context tables, about; parts of the cells.
PRIOR, PART_WORDS, CELL_PARTS = 4.0, 1_000_000, 64
CONTEXT_BITS, WORD_BITS = 44, 20
#: Words whose entries leave a task together, and those worked on at once, about.
TURN_WORDS, PIECE_WORDS = 3_000_000, 300_000
#: Log-probabilities travel in steps of 1 / SCALE, down to -32.
SCALE = 2048
#: Bytes of the longest word that numpy hashes; A-Z lower-cased and ASCII white space made spaces; masks of the first n bytes of eight.
LONG = 64
SPACED = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Words:
    """The 64-bit hash of each word of texts: words of up to LONG bytes by numpy, eight bytes at a time, longer ones by XXH3."""

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and the number of words of each text."""
        texts = [t or b"" for t in texts]
        data = b"".join((b" ", b" ".join(texts), b" " * 24)).translate(SPACED)
        space = np.frombuffer(data, np.uint8) == 32
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        begin, lengths = edges[::2], edges[1::2] - edges[::2]
        chunks = np.frombuffer(data, "<u8", len(data) // 8)

        def chunk(at: np.ndarray, left: np.ndarray) -> np.ndarray:
            """Eight bytes, or what is left of a word and zeros."""
            k, low = at >> 3, ((at & 7) << 3).astype(np.uint64)
            x = chunks[k] >> low | chunks[k + 1] << np.uint64(1) << (np.uint64(63) - low)
            return x & KEPT[np.minimum(left, 8)]

        words = mixed(lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ chunk(begin, lengths))
        more = np.flatnonzero((lengths > 8) & (lengths <= LONG))
        for step in range(8, LONG, 8):
            if not len(more):
                break
            words[more] = mixed(words[more] * np.uint64(0x9FB21C651E98DF25) + chunk(begin[more] + step, lengths[more] - step))
            more = more[lengths[more] > step + 8]
        words = mixed(words * np.uint64(0x9FB21C651E98DF25))  # mixed undoes half of itself
        for k in np.flatnonzero(lengths > LONG).tolist():
            words[k] = xxhash.xxh3_64_intdigest(data[begin[k] : begin[k] + lengths[k]])
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        return words, np.diff(np.searchsorted(begin, ends, "right"), prepend=0)


def buckets(words: np.ndarray) -> np.ndarray:
    return (words & np.uint64(BUCKETS - 1)).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def entries(words: np.ndarray, sizes: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of the tables and the entry (neighbours, word) of each word; beyond a text's ends stands 1."""
    n, ends = len(words), np.cumsum(sizes)
    left, right = np.ones(n, np.uint64), np.ones(n, np.uint64)
    left[1:], right[:-1] = words[:-1], words[1:]
    some = sizes > 0
    left[(ends - sizes)[some]] = 1
    right[ends[some] - 1] = 1
    around = mixed(mixed(left) + right)
    part = (around >> np.uint64(shift)).astype(np.uint16 if shift >= 48 else np.int64)
    return part, (around & np.uint64((1 << CONTEXT_BITS) - 1)) << np.uint64(WORD_BITS) | words >> np.uint64(64 - WORD_BITS)


def short(entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48 bits of an entry's hash, in two arrays: enough to look it up in one part."""
    h = mixed(entry)
    return h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint16)


def whole(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


def distinct(entry: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct entries in order, and their numbers (or the sums of n)."""
    if n is None:
        entry = np.sort(entry)
    else:
        order = np.argsort(entry)
        entry, n = entry[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], entry[1:] != entry[:-1]))[: len(entry)])
    if n is None:
        return entry[first], np.diff(np.append(first, len(entry)))
    return entry[first], np.add.reduceat(n, first) if len(first) else n[:0]


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as planes of bytes, which compress well where values are sorted or small."""
    return b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays)


def unpacked(blob: bytes, *types) -> list[np.ndarray]:
    types = [np.dtype(t) for t in types]
    n, at, out = len(blob) // sum(t.itemsize for t in types), 0, []
    for t in types:
        planes = np.frombuffer(blob, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(t))
        at += n * t.itemsize
    return out


def pressed(data: bytes) -> bytes:
    """Small numbers in few bits, for what is shuffled or written."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpressed(blob) -> bytes:
    blob = bytes(blob)
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)


def together(rows, names: list[str], size: int = 1 << 22):
    """Rows (number, blob, ...) in batches of about size bytes: a batch for each costs more than most blobs hold."""
    held, full = [], 0
    for r in chain(rows, [None]):
        if held and (r is None or full > size):
            number, blob, *rest = zip(*held, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(blob, pa.binary()), *map(pa.array, rest)], names)
            held, full = [], 0
        if r is not None:
            held.append(r)
            full += len(r[1]) + 64


def by_part(part: np.ndarray, *arrays: np.ndarray):
    """(part, arrays of that part) in order of parts."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))).tolist()
    arrays = [a[order] for a in arrays]
    for x, y in zip(cuts, [*cuts[1:], len(part)], strict=True):
        yield int(part[x]), [a[x:y] for a in arrays]


def texts_of(batches):
    """Tuples of the rows of batches, whose last column is a text."""
    return chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)


def parts(rows, words: int):
    """Rows (..., text) in lists of a bounded number of bytes, at least one row each."""
    part, size = [], 0
    for r in rows:
        part.append(r)
        size += len(r[-1] or b"")
        if size > 6 * words:
            yield part
            part, size = [], 0
    if part:
        yield part


@dataclass
class Vocabulary:
    """class_of: of each bucket; within: log of its share in the class, with one added to each count."""

    class_of: np.ndarray
    within: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Vocabulary:
        smoothed = counts + 1.0
        order = np.argsort(-smoothed, kind="stable")
        class_of, total, cumulative = np.empty(len(counts), np.int16), smoothed.sum(), np.cumsum(smoothed[order])
        # A class closes when it holds its share of what is left; a bucket above that is a class of its own.
        ends, begin = [], 0
        for k in range(CLASSES - 1):
            before = cumulative[begin - 1] if begin else 0.0
            rest, left = total - before, CLASSES - k
            end = max(begin + 1, int(np.searchsorted(cumulative, before + rest / left)) + 1)
            end = min(end, len(counts) - (CLASSES - k - 1))
            ends.append((begin, end))
            begin = end
        ends.append((begin, len(counts)))
        for k, (a, b) in enumerate(ends):
            class_of[order[a:b]] = k
        mass = np.bincount(class_of, weights=smoothed, minlength=CLASSES)
        return cls(class_of, np.log(smoothed / mass[class_of]).astype(np.float32))


def cell_ids(classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The cell of every word: two classes on either side, far ones in outer ids, and its own."""
    at = np.arange(len(classes)) + np.repeat(2 * np.arange(len(sizes)), sizes)
    # Class CLASSES stands twice between texts and at both ends; its outer id is OUTER.
    near = np.full(len(classes) + 2 * len(sizes) + 2, CLASSES, np.int32)
    near[at + 2] = classes
    far = near * OUTER // CLASSES
    return ((((far[:-4] * INNER_IDS + near[1:-3]) * INNER_IDS + near[3:-1]) * OUTER_IDS + far[4:]) * CLASSES + near[2:-2])[at]


class Network:
    """One hidden layer over four embedded context classes, softmax over CLASSES."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        rng = np.random.default_rng(SEED)
        shapes = {"l2": (OUTER_IDS, DIM), "l1": (INNER_IDS, DIM), "r1": (INNER_IDS, DIM), "r2": (OUTER_IDS, DIM), "h": (DIM,), "out": (DIM, CLASSES), "bias": (CLASSES,)}
        self.w = weights or {k: rng.normal(0, 0.0 if k in ("h", "bias") else 0.3, s).astype(np.float32) for k, s in shapes.items()}

    def hidden(self, context: tuple[np.ndarray, ...]) -> np.ndarray:
        x = self.w["h"] + self.w["l2"][context[0]]
        for k, c in zip(("l1", "r1", "r2"), context[1:], strict=True):
            x += self.w[k][c]
        return np.tanh(x, out=x)

    def table(self) -> np.ndarray:
        """log p(class | context) for every context and class, by cell id: contexts are few."""
        r2, rest = np.arange(CELLS // CLASSES) % OUTER_IDS, np.arange(CELLS // CLASSES) // OUTER_IDS
        r1, rest = rest % INNER_IDS, rest // INNER_IDS
        z = self.hidden((rest // INNER_IDS, rest % INNER_IDS, r1, r2)) @ self.w["out"] + self.w["bias"]
        z -= z.max(axis=1, keepdims=True)
        return (z - np.log(np.exp(z).sum(axis=1, keepdims=True))).ravel()


def train(cells: np.ndarray, counts: np.ndarray) -> Network:
    """By Adam on cells (ids) weighted by their counts."""
    net, rng = Network(), np.random.default_rng(SEED)
    if not len(cells):
        return net
    cells, counts = cells[np.argsort(cells)], counts[np.argsort(cells)]
    target, rest = cells % CLASSES, cells // CLASSES
    r2, rest = rest % OUTER_IDS, rest // OUTER_IDS
    r1, rest = rest % INNER_IDS, rest // INNER_IDS
    context = (rest // INNER_IDS, rest % INNER_IDS, r1, r2)
    weight = counts / counts.mean()
    m, v = ({k: np.zeros_like(x) for k, x in net.w.items()} for _ in range(2))
    step = 0
    for epoch in range(max(EPOCHS, min(200, 2_000_000 // len(cells)))):
        order = rng.permutation(len(cells))
        for at in range(0, len(order), BATCH):
            i = order[at : at + BATCH]
            c = tuple(x[i] for x in context)
            h = net.hidden(c)
            z = h @ net.w["out"] + net.w["bias"]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(i)), target[i]] -= 1
            p *= (weight[i] / len(i))[:, None]
            dx = (p @ net.w["out"].T) * (1 - h * h)
            g = {"out": h.T @ p, "bias": p.sum(axis=0), "h": dx.sum(axis=0)}
            for k, x in zip(("l2", "l1", "r1", "r2"), c, strict=True):
                g[k] = np.zeros_like(net.w[k])
                np.add.at(g[k], x, dx)
            step += 1
            for k, x in net.w.items():
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] ** 2 - v[k])
                x -= 0.01 * 0.99**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


def nonzero(total: np.ndarray):
    k = np.flatnonzero(total)
    for at in range(0, len(k), 100_000):
        part = k[at : at + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["k", "n"])


def grouped(batches, finish):
    """finish(part, blobs) for rows (part, blob) sorted by part; blobs is an iterator that must be used up."""
    rows = ((part, memoryview(blob.as_buffer())) for b in batches for part, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True))
    held = next(rows, None)

    def blobs(part):
        nonlocal held
        while held is not None and held[0] == part:
            yield held[1]
            held = next(rows, None)

    while held is not None:
        yield from finish(held[0], blobs(held[0]))
    release()


def seen(blobs) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a part, and (key, c, n) of its entries whose neighbours have at least two words in the corpus."""
    held, waiting, size, load = (np.empty(0, np.uint64), np.empty(0, np.int64)), [], 0, 0
    for blob in chain(blobs, [None]):
        if blob is None or size > PART_WORDS:
            held = distinct(*(np.concatenate([held[i], *[w[i] for w in waiting]]) for i in (0, 1)))
            waiting, size = [], 0
        if blob is not None:
            entry, n = unpacked(blob, "u8", "u4")
            waiting.append((entry, n.astype(np.int64)))
            size, load = size + len(entry), load + int(n.sum())
    entry, c = held
    context = entry >> np.uint64(WORD_BITS)
    first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))[: len(context)])
    n = np.repeat(np.add.reduceat(c, first) if len(first) else c, np.diff(np.append(first, len(context))))
    some = n > 1
    key = whole(*short(entry[some]))
    order = np.argsort(key)
    return load, key[order], c[some][order], n[some][order]


def log_likelihood(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_likelihood) of whole texts under the corpus' own model.

    log_likelihood sums log p(word | both sides) over all words; null and empty texts have no words, sum 0
    and mean null.  Every row gives a row, repeated and null ids too; other columns are ignored.  Texts of any
    length are taken whole; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    spark = docs.sparkSession
    context, scratch = spark.sparkContext, Scratch(spark, "lm")

    def count(batches):
        total, words = np.zeros(BUCKETS, np.int64), Words()
        for piece in parts(texts_of(batches), PIECE_WORDS):
            total += np.bincount(buckets(words([r[-1] for r in piece])[0]), minlength=BUCKETS)
        yield from nonzero(total)

    got = rows.select("text").mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows
    counts = np.zeros(BUCKETS, np.int64)
    counts[got.column("k").to_numpy()] = got.column("n").to_numpy()
    vocabulary = Vocabulary.of(counts)
    #: Parts of the context tables: their number grows with the corpus.
    parted = 1 << max(5, int(counts.sum() // PART_WORDS).bit_length())
    shift = 64 - parted.bit_length() + 1
    #: Few parts to a task: what it sorts and streams stays far below a batch of Arrow.
    spread = min(parted, 8192)
    shared = context.broadcast(vocabulary.class_of)  # BUCKETS numbers

    def gather(batches):
        """Counts of entries in parts from 0, and of class cells in CELL_PARTS parts beyond."""

        def made():
            words, total = Words(), np.zeros(CELLS, np.int64)
            for turn in parts(texts_of(batches), TURN_WORDS):
                held = []
                for piece in parts(turn, PIECE_WORDS):
                    flat, sizes = words([r[-1] for r in piece])
                    np.add.at(total, cell_ids(shared.value[buckets(flat)], sizes), 1)
                    held.append(entries(flat, sizes, shift))
                for k, (x,) in by_part(*map(np.concatenate, zip(*held, strict=True))):
                    x, n = distinct(x)
                    yield k, packed(x, n.astype(np.uint32))
            k = np.flatnonzero(total)
            for p, x in by_part(k % CELL_PARTS, k, total[k]):
                yield parted + p, packed(*x)

        yield from together(made(), ["part", "blob"])
        release()

    def collect(batches):
        """Parts of the context tables (key, c, n), with their load, and summed cells."""

        def finish(part, blobs):
            if part >= parted:
                total = np.zeros(CELLS, np.int64)
                for blob in blobs:
                    k, n = unpacked(blob, "i8", "i8")
                    total[k] += n
                k = np.flatnonzero(total)
                yield part, packed(k, total[k]), 0
            else:
                load, key, c, n = seen(blobs)
                yield part, pressed(packed(key, c, n)), load

        yield from together(grouped(batches, finish), ["part", "blob", "load"])

    tables = rows.select("text").mapInArrow(gather, "part long, blob binary").repartition(spread, "part").sortWithinPartitions("part")
    tables = scratch.write(tables.mapInArrow(collect, "part long, blob binary, load long"), "contexts")
    cells, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for r in tables.where(F.col("part") >= parted).select("blob").toLocalIterator():  # CELLS cells at most
        k, n = unpacked(bytes(r[0]), "i8", "i8")
        cells.append(k)
        sizes.append(n)
    net = train(np.concatenate(cells), np.concatenate(sizes))
    #: Parts with many words of few neighbours are scored in several tasks; they number at most ``parted`` / 2.
    heavy = {r[0]: -(-r[1] // (2 * PART_WORDS)) for r in tables.where((F.col("part") < parted) & (F.col("load") > 2 * PART_WORDS)).select("part", "load").collect()}
    model = context.broadcast((vocabulary.class_of, vocabulary.within, net.w, heavy))

    def predict(batches):
        """The network's log p of every word, in parts like those of the tables, and every row's own sums beyond."""
        class_of, within, weights, salts = model.value
        lookup, words, task = Network(weights).table(), Words(), TaskContext.get().partitionId()

        def made():
            at = 0
            for number, turn in enumerate(parts(texts_of(batches), TURN_WORDS)):
                own, held, done = [], [], 0
                start = np.array([task << 33 | at], np.int64).tobytes()
                for piece in parts(turn, PIECE_WORDS):
                    flat, sizes = words([r[-1] for r in piece])
                    where = buckets(flat)
                    p = lookup[cell_ids(class_of[where], sizes)] + within[where]
                    part, entry = entries(flat, sizes, shift)
                    row = np.repeat(np.arange(done, done + len(sizes), dtype=np.uint32), sizes)
                    held.append((part, *short(entry), row, np.minimum(np.rint(p * -SCALE), 65535).astype(np.uint16)))
                    total = np.concatenate(([0.0], np.cumsum(p, dtype=np.float64)))
                    end = np.cumsum(sizes)
                    own.append((sizes, total[end] - total[end - sizes]))
                    done += len(sizes)
                for k, found in by_part(*map(np.concatenate, zip(*held, strict=True))):
                    for salt, cut in enumerate(range(0, len(found[0]), PIECE_WORDS)):
                        low, high, row, step = (x[cut : cut + PIECE_WORDS] for x in found)
                        blob = start + pressed(packed(low, high, np.diff(row, prepend=np.uint32(0)).astype(np.uint32), step))
                        yield k | ((task + number + salt) % salts[k] if k in salts else 0) << 40, blob, False
                sizes, total = map(np.concatenate, zip(*own, strict=True))
                table = pa.RecordBatch.from_arrays([pa.array([r[0] for r in turn], pa.int64()), pa.array(sizes), pa.array(total)], ["doc_id", "n", "s"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as w:
                    w.write_batch(table)
                yield parted + (task + number) % parted, start + sink.getvalue().to_pybytes(), False
                at += done

        yield from together(made(), ["part", "blob", "first"])
        release()

    def update(batches):
        """(turn, blob, own): the turn's rows and their own sums, and what the contexts of a part add to those."""

        def finish(part, blobs):
            if part & (1 << 40) - 1 >= parted:
                for blob in blobs:
                    yield int(np.frombuffer(blob, np.int64, 1)[0]), bytes(blob[8:]), True
                return
            key, c, n = unpacked(unpressed(next(blobs)), "u8", "i8", "i8")
            for blob in blobs:
                start, (low, high, at_row, p) = int(np.frombuffer(blob, np.int64, 1)[0]), unpacked(unpressed(blob[8:]), "u4", "u2", "u4", "u2")
                x, at_row, p = whole(low, high), np.cumsum(at_row, dtype=np.int64), p / -SCALE
                order = np.argsort(x)  # looked up in order, neighbours in the table are in the cache
                x = x[order]
                at = np.minimum(np.searchsorted(key, x), max(0, len(key) - 1))
                hit = np.flatnonzero(key[at] == x) if len(key) else np.empty(0, np.int64)
                at, at_row, p = at[hit], at_row[order[hit]], p[order[hit]]
                more = np.log((c[at] - 1 + PRIOR * np.exp(p)) / (n[at] - 1 + PRIOR)) - p
                if len(at_row):
                    total, some = np.bincount(at_row, more), np.flatnonzero(np.bincount(at_row))
                    yield start, pressed(packed(np.diff(some, prepend=0).astype(np.uint32), total[some].astype(np.float32))), False

        yield from together(grouped((b.select(["part", "blob"]) for b in batches), finish), ["turn", "blob", "own"])

    def add(batches):
        """(doc_id, n_tokens, log_likelihood) of the rows of each turn, whose own sums come first."""

        def finish(turn, blobs):
            own = pa.ipc.open_stream(next(blobs)).read_all()
            total = own.column("s").to_numpy().copy()
            for blob in blobs:
                step, more = unpacked(unpressed(blob), "u4", "f4")
                total[np.cumsum(step, dtype=np.int64)] += more
            yield from own.select(["doc_id", "n"]).append_column("s", pa.array(total)).rename_columns(["doc_id", "n_tokens", "log_likelihood"]).to_batches()

        yield from grouped((b.select(["turn", "blob"]) for b in batches), finish)

    words = rows.mapInArrow(predict, "part long, blob binary, first boolean")
    salts = F.create_map(*[F.lit(x).cast("long") for kv in heavy.items() for x in kv]) if heavy else F.lit(None).cast("map<bigint,bigint>")
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.try_element_at(salts, F.col("part")), F.lit(1)) - 1))
    known = tables.where(F.col("part") < parted).select("part", "blob", salt.alias("salt"))
    known = known.select((F.col("part") + F.col("salt") * F.lit(1 << 40)).alias("part"), "blob", F.lit(True).alias("first"))
    # Every part has a table, if an empty one, since every word has been gathered.
    dealt = words.unionByName(known).repartition(spread, "part").sortWithinPartitions("part", F.col("first").desc())
    found = dealt.mapInArrow(update, "turn long, blob binary, own boolean")
    turns = found.repartition(spread, "turn").sortWithinPartitions("turn", F.col("own").desc())
    out = turns.mapInArrow(add, "doc_id long, n_tokens long, log_likelihood double")
    return out.select("doc_id", "n_tokens", "log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_likelihood"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_likelihood(table(spark, sf_dir, "documents"))
