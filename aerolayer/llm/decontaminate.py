"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items become sequences of words (lower-cased, ASCII punctuation dropped, digits kept).  Seeds of SEED shared words join documents with the items they may hold; where the seeds
could cover enough of an item, greedy string tiling marks the longest common run, then the next longest that
does not overlap it, and so on, by Karp-Rabin hashes of falling length.  Tiles may lie in any order, so
reordered passages count.  An item whose words are covered to COVERAGE or more has leaked into the document.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LETTERS, Scratch, release, table

#: Words in a seed, which is the shortest tile, and the share of an item's words that makes a leak.
SEED, COVERAGE = 3, 0.8
#: Bits of the filter that tells seeds of the benchmark from others before they are shuffled; it only saves work.
FILTER_BITS = 1 << 24
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: LETTERS, with digits as letters.
WORDS = bytes(c if 48 <= c <= 57 else LETTERS[c] for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    text = text or b""
    if not text.isascii():
        text = text.decode("utf-8", "surrogateescape").lower().encode("utf-8", "surrogateescape")
    return text.translate(WORDS).split()


class Codes(dict):
    """The 64-bit code of each word, never 0; a bounded number of words is remembered."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh3_64_intdigest(word) or 1
        if len(self) < 50_000:
            self[word] = code
        return code

    def __call__(self, text: bytes | None) -> np.ndarray:
        w = words_of(text)
        return np.fromiter(map(self.__getitem__, w), np.uint64, len(w))


def powers(of: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, of, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Karp-Rabin hashes (mod 2**64) of the runs of any length of a sequence, from one array of prefix sums."""

    def __init__(self, codes: np.ndarray):
        mixed = codes.astype(np.uint64)
        mixed ^= mixed >> np.uint64(31)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * powers(INVERSE, len(mixed)), dtype=np.uint64)))
        self.scale = powers(BASE, len(mixed) + 1)

    def runs(self, length: int) -> np.ndarray:
        """The hash of the run of ``length`` from each position."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.scale[:n] if n > 0 else np.empty(0, np.uint64)


def tiles(doc: np.ndarray, item: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of codes: (document start, item start, length), longest first, without overlap.

    Lengths fall from the longest that can match; at each the runs of both sides that hold nothing marked are
    found by their hashes, compared and marked.
    """
    sides, hashes = (doc, item), (Hashes(doc), Hashes(item))
    marked = [np.zeros(len(x), bool) for x in sides]
    out: list[tuple[int, int, int]] = []

    def open_runs(k: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the unmarked runs of a side."""
        taken = np.concatenate(([0], np.cumsum(marked[k])))
        at = np.flatnonzero(taken[length:] == taken[: len(taken) - length])
        return at, hashes[k].runs(length)[at]

    length = min(len(doc), len(item))
    while length >= shortest:
        (at, found), (to, wanted) = open_runs(0, length), open_runs(1, length)
        hit = np.isin(found, wanted)
        if not hit.any():
            # The longest common run is shorter: halve towards it, as all runs hold runs of half their length.
            low, high = shortest, length
            while low < high:
                mid = (low + high) // 2
                if np.isin(open_runs(0, mid)[1], open_runs(1, mid)[1]).any():
                    low = mid + 1
                else:
                    high = mid
            length = low - 1
            continue
        starts = defaultdict(list)
        for j, h in zip(to.tolist(), wanted.tolist(), strict=True):
            starts[h].append(j)
        for i, h in zip(at[hit].tolist(), found[hit].tolist(), strict=True):
            if marked[0][i : i + length].any():
                continue
            for j in starts[h]:
                if not marked[1][j : j + length].any() and (doc[i : i + length] == item[j : j + length]).all():
                    out.append((i, j, length))
                    marked[0][i : i + length] = marked[1][j : j + length] = True
                    break
        length -= 1
    return out


def seeds_of(hashes: Hashes, length: int) -> np.ndarray:
    """The seed at each position: the hash of its run, told apart from those of other lengths."""
    return hashes.runs(length) ^ np.uint64(length * 0x9FB21C651E98DF25 & (1 << 64) - 1)


def cells(seeds: np.ndarray) -> np.ndarray:
    return (seeds >> np.uint64(64 - FILTER_BITS.bit_length() + 1)).astype(np.int64)


def places(items: DataFrame, seed: int) -> DataFrame:
    """(seed, item, item_body, size, reach): each distinct seed of an item and how many words its places hold at most.

    ``items`` has the columns item, item_body and text.  Items of fewer words than a seed are seeds themselves.
    """

    def run(batches):
        codes = Codes()
        for b in batches:
            out = ([], [], [], [], [])
            for i, body, t in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                x = codes(t)
                if len(x):
                    k = min(seed, len(x))
                    found, n = np.unique(seeds_of(Hashes(x), k), return_counts=True)
                    for c, v in zip(out, (found.view(np.int64), np.full(len(n), i), np.full(len(n), body), np.full(len(n), len(x), np.int32), (n * k).astype(np.int64)), strict=True):
                        c.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["seed", "item", "item_body", "size", "reach"])

    return items.mapInArrow(run, "seed long, item long, item_body long, size int, reach long")


def filter_of(seeds: DataFrame) -> bytes:
    """A bit for each cell of hashes that holds a seed: FILTER_BITS of them, however many seeds there are."""

    def run(batches):
        bits = np.zeros(FILTER_BITS, bool)
        for b in batches:
            bits[cells(b.column(0).to_numpy().view(np.uint64))] = True
        got = np.flatnonzero(bits)
        for at in range(0, len(got), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(got[at : at + (1 << 16)].astype(np.int32))], ["cell"])
        release()

    bits = np.zeros(FILTER_BITS, bool)
    bits[seeds.select("seed").mapInArrow(run, "cell int").distinct().toArrow().column("cell").to_numpy()] = True
    return np.packbits(bits, bitorder="little").tobytes()


def marked_seeds(texts: DataFrame, lengths: list[int], known) -> DataFrame:
    """(id, body, seeds, residue) of the texts (id, body, text) with seeds in the filter ``known``.

    seeds are the distinct ones; residue holds the codes of all words under them in order, with a 0 where others
    stood between: all that tiling can ever match of a text.
    """

    def run(batches):
        codes, bits = Codes(), np.frombuffer(known.value, np.uint8)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part, out = b.slice(at, 512), ([], [], [], [])
                for i, body, t in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    x = codes(t)
                    h, covered, got = Hashes(x), np.zeros(len(x) + 1, np.int64), []
                    for k in lengths:
                        s = seeds_of(h, k)
                        cell = cells(s)
                        hit = np.flatnonzero((bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1)
                        np.add.at(covered, hit, 1)
                        np.add.at(covered, hit + k, -1)
                        got.append(s[hit])
                    got = np.unique(np.concatenate(got))
                    if len(got):
                        under = np.cumsum(covered[:-1]) > 0
                        ends = under & ~np.concatenate((under[1:], [False]))
                        held = np.where(under, x, np.uint64(0))[under | np.concatenate(([False], ends[:-1]))]
                        for c, v in zip(out, (i, body, got.view(np.int64), held.tobytes()), strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(out, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()), strict=True)], ["id", "body", "seeds", "residue"])
        release()

    return texts.mapInArrow(run, "id long, body long, seeds array<long>, residue binary")


def leaks(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, coverage, tiles) of each document and each item that has leaked into it.

    coverage is the share of the item's words under tiles, tiles their number.  Whole texts are searched,
    however long.  Null texts, items without words and rows of null ids match nothing; repeated rows give
    repeated results; an empty benchmark or no documents give an empty result; other columns are ignored.
    Items of fewer words than a seed are sought as a whole.  The corpus is read once, whatever the benchmark's
    size; what is shuffled of it are seeds that the benchmark has too.
    """
    scratch, context = Scratch(docs.sparkSession, "tiling"), docs.sparkSession.sparkContext

    def texts(df: DataFrame, name: str, *names: str) -> DataFrame:
        text = F.col("text").cast("binary")
        return df.where(f"{name} is not null and text is not null").select(*[c.alias(n) for c, n in zip((F.col(name).cast("long"), F.xxhash64(text), text), names, strict=True)])

    items = texts(benchmark, "item_id", "item", "item_body", "item_text")
    wanted = scratch.write(places(items.dropDuplicates(["item", "item_body"]), seed), "wanted")
    lengths = sorted(r[0] for r in wanted.select(F.least("size", F.lit(seed))).distinct().collect())  # ``seed`` of them at most
    if not lengths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, coverage double, tiles int")
    known = context.broadcast(filter_of(wanted))  # FILTER_BITS / 8 bytes
    marks = scratch.write(marked_seeds(texts(docs, "doc_id", "id", "body", "text"), lengths, known), "marks")
    # How many words of an item a text's seeds can reach: tiles cover no more.
    found = marks.select("id", "body", F.explode("seeds").alias("seed")).join(wanted, "seed")
    pairs = found.groupBy("id", "body", "item", "item_body").agg(F.sum("reach").alias("reach"), F.max("size").alias("size"))
    pairs = scratch.write(pairs.where(F.col("reach") >= coverage * F.col("size")).select("id", "body", "item", "item_body"), "pairs")

    def tile(batches):
        codes = Codes()
        for b in batches:
            out = ([], [], [], [])
            for i, residue, item, text in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                x = codes(text)
                got = tiles(np.frombuffer(residue, np.uint64), x, min(seed, len(x)))
                share = sum(n for _, _, n in got) / len(x)
                if share >= coverage:
                    for c, v in zip(out, (i, item, share, len(got)), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.int32()), strict=True)], ["doc_id", "item_id", "coverage", "tiles"])
        release()

    full = marks.join(pairs, ["id", "body"]).join(items, ["item", "item_body"]).select("id", "residue", "item", "item_text")
    return full.mapInArrow(tile, "doc_id long, item_id long, coverage double, tiles int")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents without those into which an item has leaked; rows with a null doc_id or text stay."""
    scratch = Scratch(docs.sparkSession, "leaks")
    found = scratch.write(leaks(docs, benchmark).select("doc_id").distinct(), "ids")
    return docs.join(found, docs["doc_id"].cast("long") == found["doc_id"], "left_anti")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
