"""SimHash near-duplicates: fingerprints joined through vantage-point trees.

A vantage-point tree splits fingerprints by their Hamming distance to a vantage point.  Whatever lies
within ``radius`` beyond a split is copied to the inner side, so every pair at ``radius`` or fewer bits
meets in one shard and the triangle bound discards the rest.  The upper levels (fitted on a bounded
sample of fingerprints) shard the table; each shard grows its own tree in its task and returns a
spanning forest of the links inside it, never all pairs of a group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, connected_components, release, table

#: Fingerprints of a shard read on the driver to choose the vantage points of the levels below it.
SAMPLE = 4096
#: Fingerprints in a shard, at least; of n of them, shards have about 8 * sqrt(n).
SHARD = 2048
#: Fingerprints in a leaf, compared with one another.
LEAF = 512
#: Bands of the similarity stage, shingles sampled for each, words in a shingle, least similarity.
BANDS, ROWS, WORDS, SIMILARITY = 12, 3, 5, 0.8
#: Bins of a sketch; pairs whose estimate falls MARGIN short of SIMILARITY are not verified (over three standard
#: deviations); members compared in one task at a time, and their shingles; leaders that a member is verified against.
BINS, MARGIN, CHUNK, TOP, LOAD = 128, 0.12, 2048, 3, 4_000_000


def shingle_hashes(text: bytes | None, k: int) -> np.ndarray:
    """XXH64 (seed 42) of every k-word shingle, repeats included; the whole sequence if shorter."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([h(joined, 42)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[: -k])).tolist()
    return np.array([h(joined[s:e], 42) for s, e in zip(starts, (ends[k - 1 :] - 1).tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint: bit i is 1 if set in over half of the hashes; 0 without any."""
    n = len(hashes)
    if n == 0:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def signed(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, fp long) of whole texts; null texts count as empty."""

    def run(batches):
        for b in batches:
            fp = [majority(shingle_hashes(t, k)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(signed(np.array(fp, np.uint64)))], ["doc_id", "fp"])
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def split(points: np.ndarray, vantage: np.uint64, radius: int) -> tuple[int, np.ndarray]:
    """The distance at which inner points with their overlap are about as many as outer ones."""
    d = np.bitwise_count(points ^ vantage)
    within = np.cumsum(np.bincount(d, minlength=65 + radius))
    mu = int(np.argmin(np.abs(within[radius:] - (within[-1] - within[: len(within) - radius]))))
    return mu, d


def grow(sample: np.ndarray, depth: int, radius: int, rng: np.random.Generator) -> list | None:
    """Upper levels: [vantage, mu, inner, outer], None for a shard."""
    if depth == 0 or len(sample) < 8:
        return None
    v = sample[rng.integers(len(sample))]
    mu, d = split(sample, v, radius)
    inner, outer = sample[d <= mu], sample[d > mu]
    if min(len(inner), len(outer)) < 2:
        return None
    return [int(v), mu, grow(inner, depth - 1, radius, rng), grow(outer, depth - 1, radius, rng)]


def route(tree: list | None, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) pairs: each point's own shard and those whose boundary it overlaps."""
    rows, shards, stack = [], [], [(tree, np.arange(len(points)), 1)]
    while stack:
        node, at, name = stack.pop()
        if node is None or len(at) == 0:
            rows.append(at)
            shards.append(np.full(len(at), name, np.int64))
            continue
        d = np.bitwise_count(points[at] ^ np.uint64(node[0]))
        stack += [(node[2], at[d <= node[1] + radius], 2 * name), (node[3], at[d > node[1]], 2 * name + 1)]
    return np.concatenate(rows), np.concatenate(shards)


def leaf_links(f: np.ndarray, at: np.ndarray, radius: int, out: list) -> None:
    """A spanning forest of the links among points ``at``, by breadth-first search in blocks."""
    if len(at) <= LEAF:
        near = np.bitwise_count(f[at][:, None] ^ f[at][None, :]) <= radius
        if near.sum() == len(at):
            return
        labels = np.arange(len(at))
        while True:
            new = np.where(near, labels[None, :], len(at)).min(axis=1)
            if (new == labels).all():
                break
            labels = new
        moved = labels != np.arange(len(at))
        out += [(at[moved], at[labels[moved]])]
        return
    left = at
    while len(left):
        seed, left, frontier = left[0], left[1:], left[:1]
        while len(frontier) and len(left):
            hit = np.zeros(len(left), bool)
            for p in frontier[:256]:
                hit |= np.bitwise_count(f[left] ^ f[p]) <= radius
            found, left = left[hit], left[~hit]
            out += [(found, np.full(len(found), seed))]
            frontier = np.concatenate((frontier[256:], found))


def links(f: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of all pairs at ``radius`` or fewer bits among distinct fingerprints f."""
    out: list = []
    rng, stack = np.random.default_rng(len(f)), [np.arange(len(f))]
    while stack:
        at = stack.pop()
        best = None
        if len(at) > LEAF:
            for _ in range(3):
                mu, d = split(f[at], f[at[rng.integers(len(at))]], radius)
                sides = at[d <= mu + radius], at[d > mu]
                if best is None or len(sides[0]) + len(sides[1]) < len(best[0]) + len(best[1]):
                    best = sides
                if max(map(len, best)) < 0.8 * len(at):
                    break
        if best is None or max(map(len, best)) > 0.95 * len(at):
            leaf_links(f, at, radius, out)
        else:
            stack += best
    return out


def deal(rows: DataFrame, trees: dict, radius: int) -> DataFrame:
    """(shard, fp, rep) of rows (shard, fp, rep) below the upper levels ``trees``: {shard: (tree, first name below it)}.

    A fingerprint goes to its own shard and to those whose boundary it overlaps.
    """

    def run(batches):
        for b in batches:
            shard, fp = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            for name in np.unique(shard).tolist():
                tree, first = trees[name]
                here = np.flatnonzero(shard == name)
                at, below = route(tree, fp[here], radius)
                got = b.take(pa.array(here[at]))
                yield pa.RecordBatch.from_arrays([pa.array(first + below), got.column(1), got.column(2)], ["shard", "fp", "rep"])

    return rows.mapInArrow(run, "shard long, fp long, rep long")


def link_fingerprints(reps: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) between ``rep`` ids whose distinct fingerprints ``fp`` differ in ``radius`` or fewer bits.

    Returns links that span every component; pairs inside a component need not all be listed, but every pair
    has a common a (or is an edge): edges are stars around the a of a chain of fingerprints in one leaf.  Shards that
    come out too large get upper levels of their own, from a bounded sample of theirs, until none is or no
    vantage point parts them any more: those are balls of fingerprints that lie within a few bits.
    """
    scratch, n = Scratch(reps.sparkSession, "shards"), reps.count()
    size, rng = max(SHARD, SHARD * math.isqrt(n) // 256), np.random.default_rng(7)
    done, next_name, large = [], 1, {0: n} if n > size else {}
    rows = reps.select(F.lit(0).cast("long").alias("shard"), "fp", "rep")
    if not large:
        done, rows = [rows], None
    while rows is not None:
        # At most SAMPLE fingerprints of each large shard, by hash; shards number n / size at most.
        share = F.element_at(F.create_map(*[F.lit(x) for k, c in large.items() for x in (float(k), SAMPLE / c)]), F.col("shard").cast("double"))
        hashed = F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) / (1 << 20)
        sample: dict[int, list] = {}
        for r in rows.select("shard", "fp").where(hashed < share).orderBy("shard", F.xxhash64("fp"), "fp").toLocalIterator():
            sample.setdefault(r[0], []).append(r[1])
        trees = {}
        for name, c in large.items():
            depth = math.ceil(math.log2(c / size))
            trees[name] = (grow(np.array(sample.get(name, []), np.int64).view(np.uint64), depth, radius, rng), next_name)
            next_name += 2 << depth
        dealt = scratch.write(deal(rows, trees, radius), "dealt")
        counts = {r[0]: r[1] for r in dealt.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > 2 * size).collect()}
        firsts = sorted((first, large[name]) for name, (_, first) in trees.items())
        parent = lambda name: max(x for x in firsts if x[0] <= name)[1]
        large = {name: c for name, c in counts.items() if c < 0.9 * parent(name)}
        done.append(dealt.where(~F.col("shard").isin(list(large))) if large else dealt)
        rows = dealt.where(F.col("shard").isin(list(large))) if large else None

    def join(batch: pa.Table) -> pa.Table:
        f, rep = (batch.column(x).to_numpy() for x in ("fp", "rep"))
        f = np.ascontiguousarray(f).view(np.uint64)
        found = links(f, radius)
        a, b = (np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for i in (0, 1))
        pairs = np.unique(np.stack([rep[b], rep[a]], axis=1), axis=0)
        return pa.table({"a": pairs[:, 0].astype(np.int64), "b": pairs[:, 1].astype(np.int64)})

    dealt = done[0]
    for more in done[1:]:
        dealt = dealt.unionByName(more)
    return dealt.groupBy("shard").applyInArrow(join, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): SimHash classes of whole texts.

    Fingerprints at ``radius`` or fewer differing bits are linked, component_id is the smallest doc_id
    reachable.  Null and empty texts share fingerprint zero.  Equal fingerprints form one class before
    any comparison, so exact copies are never paired.  Rows with a null doc_id keep their fingerprint and
    join a class without naming it; a class of such rows alone has a null component_id.  Repeated rows
    stay repeated, other columns are ignored, an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.write(fingerprints(docs, k), "fps")
    reps = scratch.write(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "reps")
    #: A class of null ids takes part under a name of its own.
    named = reps.select("fp", "least", F.coalesce("least", F.xxhash64("fp")).alias("rep"))
    edges = scratch.write(link_fingerprints(named, radius), "edges")
    comps = scratch.write(connected_components(edges, "a", "b"), "comps")
    full = named.join(comps, named["rep"] == comps["node"], "left").select("fp", "least", "rep", "component")
    if reps.where("least is null").limit(1).count():
        ids = full.groupBy(F.coalesce("component", "rep").alias("c")).agg(F.min("least").alias("component_id"))
        full = full.join(ids, F.coalesce("component", "rep") == F.col("c")).select("fp", "component_id")
    else:
        full = full.select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(full, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, body, size, fp, bands, sketch): what the similarity stage knows of each text.

    body names the normalised word sequence, size counts its distinct shingles of WORDS words, fp is their
    SimHash, and bands holds the SimHash of ROWS min-wise sampled shingles for each of BANDS bands: texts
    that share SIMILARITY of their shingles agree in some band with probability 1 - (1 - 0.8**3)**12 = 0.9998.
    sketch has 16 bits of the least hash in each of BINS bins, 0 for empty bins.
    """

    def run(batches):
        mix = np.random.default_rng(11).integers(1, 2**63, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
        for b in batches:
            body, size, fp, bands, sketch = [], [], [], [], []
            for t in b.column(1).to_pylist():
                h = shingle_hashes(t, WORDS)
                body.append(xxhash.xxh3_128_hexdigest(b" ".join((t or b"").lower().split())))
                fp.append(majority(h))
                h = np.unique(h)
                size.append(len(h))
                bins, first = np.unique(h >> np.uint64(64 - 7), return_index=True)
                cells = np.zeros(BINS, np.uint16)
                cells[bins.astype(np.int64)] = (h[first] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16) | np.uint16(1)
                sketch.append(cells.tobytes())
                least, picked = np.full(BANDS * ROWS, np.iinfo(np.uint64).max), np.zeros(BANDS * ROWS, np.uint64)
                for at in range(0, len(h), 16384):
                    part = h[at : at + 16384]
                    x = part * mix
                    x ^= x >> np.uint64(29)
                    x *= np.uint64(0x9E3779B97F4A7C15)
                    i = x.argmin(axis=1)
                    x = x[np.arange(len(x)), i]
                    picked = np.where(x <= least, part[i], picked)
                    least = np.minimum(x, least)
                bands.append([majority(r) for r in picked.reshape(BANDS, ROWS)])
            flat = pa.array(signed(np.array(bands, np.uint64).reshape(-1)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1) * BANDS, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(body, pa.string()), pa.array(size, pa.int32()), pa.array(signed(np.array(fp, np.uint64))), lists, pa.array(sketch, pa.binary())],
                ["doc_id", "body", "size", "fp", "bands", "sketch"],
            )
        release()

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, body string, size int, fp long, bands array<long>, sketch binary")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, shingles): the sorted distinct shingle hashes of whole texts."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                sets = [signed(np.unique(shingle_hashes(t, WORDS))) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])
        release()

    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated similarity of a sketch to several."""
    used = (one != 0) | (many != 0)
    return ((one == many) & used).sum(axis=1) / np.maximum(used.sum(axis=1), 1)


def group_candidates(rep: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs of a group worth verifying, and its leaders (mutually unlike members, by position).

    A member is a candidate with the TOP likest leaders so far, and with the likest member that follows each.
    It follows the first where the estimate is clearly above SIMILARITY, and else becomes a leader itself; so
    pairs grow with members, not with their square, however alike a group is.
    """
    order = np.lexsort((rep, -size))
    leaders, followers, pairs = np.empty(0, np.int64), {}, []
    for i in order.tolist():
        if len(leaders):
            e = estimates(sketch[i], sketch[leaders])
            best = np.argsort(-e, kind="stable")[:TOP].tolist()
            if e[best[0]] >= 1 - MARGIN / 2:
                best = best[:1]
            for k in best:
                if e[k] >= SIMILARITY - MARGIN:
                    pairs.append((leaders[k], i))
                if SIMILARITY - 2 * MARGIN <= e[k] < SIMILARITY + MARGIN / 2 and (own := followers[int(leaders[k])]):
                    f = estimates(sketch[i], sketch[own])
                    if f.max() >= SIMILARITY - MARGIN:
                        pairs.append((own[int(f.argmax())], i))
            if e[best[0]] >= SIMILARITY + MARGIN / 2:
                followers[int(leaders[best[0]])].append(i)
                continue
        leaders = np.append(leaders, i)
        followers[i] = []
    return [(int(rep[a]), int(rep[b])) for a, b in pairs], leaders


def by_group(batches, names: tuple[str, ...], finish):
    """Batches of finish(rows of a group) for rows that are sorted by the columns ``names``; holds a group at a time."""
    held, now, out = [], None, []
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in names], axis=1) if batch.num_rows else np.empty((0, len(names)))
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for x, y in zip(cuts, cuts[1:]):
            if x == y:
                continue
            key = tuple(keys[x].tolist())
            if key != now and held:
                out.append(finish(pa.Table.from_batches(held)))
                held = []
                if len(out) == 256:
                    yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                    out = []
            now = key
            held.append(batch.slice(x, y - x))
    if held:
        out.append(finish(pa.Table.from_batches(held)))
    if out:
        yield from pa.Table.from_batches(out).combine_chunks().to_batches()
    held.clear()
    out.clear()
    release()


def sketches(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint16).reshape(-1, BINS)


def found_pairs(t: pa.Table, a: list, b: list) -> pa.RecordBatch:
    band, fp = t.column("band")[0].as_py(), t.column("fp")[0].as_py()
    return pa.RecordBatch.from_arrays([pa.array([band] * len(a), pa.int32()), pa.array([fp] * len(a), pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["band", "fp", "a", "b"])


def candidates_within(rows: DataFrame) -> DataFrame:
    """(band, fp, a, b) of rows (band, fp, chunk, rep, size, sketch): pairs to verify, and leaders, with b null.

    Chunks are sorted side by side in partitions and streamed; a task holds one chunk at a time.
    """

    def finish(t):
        rep, size = (t.column(c).to_numpy() for c in ("rep", "size"))
        rep, first = np.unique(rep, return_index=True)
        pairs, leaders = group_candidates(rep, size[first], sketches(t)[first])
        return found_pairs(t, [p[0] for p in pairs] + rep[leaders].tolist(), [p[1] for p in pairs] + [None] * len(leaders))

    keys = ("band", "fp", "chunk")
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "rep", "size", "sketch")
    return dealt.mapInArrow(lambda batches: by_group(batches, keys, finish), "band int, fp long, a long, b long")


def alike(ra: np.ndarray, na: np.ndarray, ca: np.ndarray, ga: np.ndarray, sa: np.ndarray, row: tuple, main: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Members that ``row`` (rep, size, component, bands, sketch) may be SIMILARITY alike, and the estimates.

    Left out are those of its own component, of other sizes or sketches, and, so that a pair is met once: of two
    members outside the main component the other order, and those that share an earlier band.
    """
    rep, size, component, bands, sketch = row
    may = (ca != component) & ((ca == main) | (ra < rep)) & (np.minimum(na, size) >= SIMILARITY * np.maximum(na, size))
    k = np.flatnonzero(may)
    k = k[~(ga[k, :band] == bands[:band]).any(axis=1)]
    e = estimates(sketch, sa[k])
    return k[e >= SIMILARITY - MARGIN], e[e >= SIMILARITY - MARGIN]


def group_arrays(t: pa.Table) -> tuple[np.ndarray, ...]:
    """rep, size, component, bands and sketch of members."""
    bands = pc.list_flatten(t.column("bands")).to_numpy().reshape(-1, BANDS)
    return *(t.column(c).to_numpy() for c in ("rep", "size", "component")), bands, sketches(t)


def earlier_bands(t: pa.Table) -> int:
    """Bands whose groups come before this one; groups of fingerprints (band -1) come last."""
    band = t.column("band")[0].as_py()
    return BANDS if band < 0 else band


def open_members(one: pa.Table, two: pa.Table) -> np.ndarray:
    """The reps of members with a pair (see ``alike``): a row for a member, however many pairs it has."""
    main, band = two.column("main")[0].as_py(), earlier_bands(two)
    a, b = group_arrays(one), group_arrays(two)
    hit, some = np.zeros(len(a[0]), bool), np.zeros(len(b[0]), bool)
    for i in range(len(some)):
        k, _ = alike(*a, tuple(x[i] for x in b), main, band)
        hit[k] = True
        some[i] = len(k) > 0
    return np.union1d(a[0][hit], b[0][some])


def verified_links(one: pa.Table, two: pa.Table) -> list[tuple[int, int]]:
    """Links of SIMILARITY on whole shingle sets that span all those between members of different components.

    Every pair that ``alike`` gives is verified, the likest first, unless links found here have joined the two.
    """
    main, band = two.column("main")[0].as_py(), earlier_bands(two)
    a, b = group_arrays(one), group_arrays(two)
    sa, sb = ([x.values.to_numpy().view(np.uint64) for x in t.column("shingles")] for t in (one, two))  # sorted as such
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := parent.get(c, c)) != c:
            parent[c] = c = parent.get(up, up)
        return c

    out = []
    for i in range(len(sb)):
        k, e = alike(*a, tuple(x[i] for x in b), main, band)
        own = int(b[2][i])
        for j in k[np.argsort(-e, kind="stable")].tolist():
            if (x := root(int(a[2][j]))) == (y := root(own)):
                continue
            at = np.minimum(np.searchsorted(sb[i], sa[j]), len(sb[i]) - 1)
            shared = int((sb[i][at] == sa[j]).sum())
            if shared >= SIMILARITY * (len(sa[j]) + len(sb[i]) - shared):
                parent[x] = y
                out.append((int(a[0][j]), int(b[0][i])))
    return out


def cells(named: DataFrame, reps: DataFrame, load: int) -> DataFrame:
    """Members (band, fp, rep, component) of groups with several components, dealt into cells (band, fp, i, j).

    All members of a group (second false) meet those outside its main component (second true); neither
    side of a cell has much more than CHUNK members or ``load`` shingles.
    """
    sized = named.join(reps.select("rep", "size"), "rep")
    parts = sized.groupBy("band", "fp", "component").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    groups = parts.groupBy("band", "fp").agg(F.max(F.struct("n", "component", "s")).alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s")).where("n > top.n")
    count = lambda n, s: F.greatest(F.ceil(n / CHUNK), F.ceil(s / load)).cast("int")
    groups = groups.select("band", "fp", F.col("top.component").alias("main"), count(F.col("n"), F.col("s")).alias("ones"), count(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("twos"))
    rows = named.join(groups, ["band", "fp"])
    own, every = (lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")), (lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
    held = ("rep", "component", "main")
    one = rows.select("band", "fp", own("ones").alias("i"), every("twos").alias("j"), F.lit(False).alias("second"), *held)
    two = rows.where("component <> main").select("band", "fp", every("ones").alias("i"), own("twos").alias("j"), F.lit(True).alias("second"), *held)
    return one.unionByName(two)


def by_cell(rows: DataFrame, finish, schema: str) -> DataFrame:
    """finish(rows of a cell, its one and two side) of rows of ``cells``, a cell at a time."""
    keys = ("band", "fp", "i", "j")

    def sides(t):
        second = t.column("second")
        return finish(t, t.filter(pc.invert(second)), t.filter(second))

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(lambda batches: by_group(batches, keys, sides), schema)


def links_left(reps: DataFrame, members: DataFrame, comps: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links that span those between members (band, fp, rep) of a group that ``comps`` has not joined yet.

    Pairs are never rows: sketches leave the members that have a pair at all, and those meet again with their
    shingle sets, where each cell verifies its pairs and gives a forest of their links.
    """
    named = members.join(comps, members["rep"] == comps["node"], "left").select("band", "fp", "rep", F.coalesce("component", "rep").alias("component"))

    def opened(t, one, two):
        rep = open_members(one, two) if len(one) and len(two) else np.empty(0, np.int64)
        return found_pairs(t, rep.tolist(), [None] * len(rep))

    schema, marks = "band int, fp long, a long, b long", reps.select("rep", "size", "bands", "sketch")
    left = by_cell(cells(named, reps, 1 << 40).join(marks, "rep"), opened, schema).select("band", "fp", F.col("a").alias("rep")).distinct()
    left = scratch.write(left, "left")
    ids = scratch.write(left.select(F.col("rep").alias("doc_id")).distinct(), "ids")
    sets = whole_sets(docs, ids, scratch)
    rows = cells(left.join(named, ["band", "fp", "rep"]), reps, LOAD).join(marks, "rep").join(sets.withColumnRenamed("doc_id", "rep"), "rep")

    def linked(t, one, two):
        found = verified_links(one, two) if len(one) and len(two) else []
        return found_pairs(t, [x for x, _ in found], [x for _, x in found])

    links = scratch.write(by_cell(rows, linked, schema).select("a", "b").distinct(), "links")
    scratch.drop(left, ids, sets)
    return links


def band_candidates(reps: DataFrame, near: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(a, b) to verify first among classes of a group, and all members (band, fp, rep) of groups.

    Groups are classes that share a band's fingerprint, and those of ``near`` (rows of the same columns).
    Groups beyond CHUNK go through in chunks, whose leaders form the group of the next level, while levels
    shrink.  These pairs join most of a group with few links; ``links_left`` finds what they leave out.
    """
    members = reps.select("rep", F.posexplode("bands").alias("band", "fp")).unionByName(near)
    counts = members.groupBy("band", "fp").agg(F.count("*").alias("n"))
    counts = scratch.write(counts.where("n > 1"), "groups")
    members = scratch.write(members.join(counts, ["band", "fp"]), "members")
    found, before, every = reps.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0), None, members.select("band", "fp", "rep")
    while (total := members.count()) and (before is None or total <= 0.9 * before):
        chunks = F.ceil(F.col("n") / CHUNK).cast("int")
        rows = members.withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks).cast("int")).join(reps.select("rep", "size", "sketch"), "rep")
        out = scratch.write(candidates_within(rows.select("band", "fp", "chunk", "rep", "size", "sketch")), "within")
        found = found.unionByName(out.where("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        before = total
        left = out.where("b is null").join(counts.where(F.col("n") > CHUNK), ["band", "fp"]).select("band", "fp", F.col("a").alias("rep"))
        counts = scratch.write(left.groupBy("band", "fp").agg(F.count("*").alias("n")), "groups")
        members = scratch.write(left.join(counts, ["band", "fp"]), "members")
    return found, every


def whole_sets(docs: DataFrame, ids: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, shingles) of the documents ``ids``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return scratch.write(shingle_sets(texts.join(ids, "doc_id", "left_semi")).dropDuplicates(["doc_id"]), "sets")


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of texts that share SIMILARITY of their shingles."""
    sizes = [reps.select(F.col("rep").alias(x), F.col("size").alias(f"n{x}")) for x in "ab"]
    close = pairs.join(sizes[0], "a").join(sizes[1], "b").where((F.least("na", "nb") >= SIMILARITY * F.greatest("na", "nb")) & (F.greatest("na", "nb") > 0))
    close = scratch.write(close.select("a", "b"), "close")
    ids = scratch.write(close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    sets = whole_sets(docs, ids, scratch)
    one, two = (sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    shared = F.size(F.array_intersect("sa", "sb"))
    like = close.join(one, "a").join(two, "b").where(shared >= SIMILARITY * (F.size("sa") + F.size("sb") - shared)).select("a", "b")
    like = scratch.write(like, "like")
    scratch.drop(close, ids, sets)
    return like


def similar_classes(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, component_id) of documents, by verified links of SIMILARITY or more.

    Exact copies form one class before any comparison.  Candidates are the pairs of two kinds of groups: chains
    of fingerprints of whole texts at 3 bits or fewer in the leaves of the vantage-point trees, and classes that share a
    band's fingerprint.  All pairs of a group whose sketches may be SIMILARITY alike are verified on their shingle
    sets, unless verified links have joined them already.
    """
    marks = scratch.write(signatures(docs), "signatures")
    reps = marks.groupBy("body").agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("size", "fp", "bands", "sketch")])
    reps = scratch.write(reps, "reps")
    names = scratch.write(marks.select("doc_id", "body"), "names")
    scratch.drop(marks)
    # The trees' links are stars, whose members need not be near the middle but may be near one another: each is a group like those of bands.
    points = scratch.write(reps.groupBy("fp").agg(F.min("rep").alias("point")), "points")
    stars = link_fingerprints(points.select("fp", F.col("point").alias("rep")), 3).select(F.col("a").alias("star"), F.col("b").alias("point"))
    stars = scratch.write(stars.unionByName(points.select(F.col("point").alias("star"), "point")).distinct(), "stars")
    near = reps.select("rep", "fp").join(points, "fp").join(stars, "point").select("rep", F.lit(-1).alias("band"), F.col("star").alias("fp"))
    banded, members = band_candidates(reps, near, scratch)
    like = verified(scratch.write(banded.distinct(), "pairs"), reps, docs, scratch)
    comps = scratch.write(connected_components(like, "a", "b"), "comps")
    more = links_left(reps, members, comps, docs, scratch)
    if more.limit(1).count():
        comps = scratch.write(connected_components(like.unionByName(more), "a", "b"), "comps")
    named = reps.select("body", "rep").join(comps, reps["rep"] == comps["node"], "left").select("body", F.coalesce("component", "rep").alias("component_id"))
    return names.join(scratch.write(named, "named"), "body").select("doc_id", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """documents with one document of each group: the one of the smallest doc_id.

    Groups are chains of documents that share 0.8 or more of their distinct five-word shingles (texts of
    fewer words are one shingle; all texts without words are copies of one another; null texts count as
    empty).  Letters A-Z and white space don't distinguish copies.  Rows with a null doc_id stay; repeated
    rows share a doc_id and count as one document.  Other columns stay as they are.
    """
    scratch = Scratch(docs.sparkSession, "similar")
    classes = similar_classes(docs, scratch)
    gone = scratch.write(classes.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
