"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are words and their characters: each word is a hashed word vector plus the mean of the hashed
vectors of its character trigrams (with boundary marks), both learned.  All overlapping windows of WINDOW
words (every STRIDE words, the last one flush with the end) are scored, and the most toxic window scores
the document.  Training sees documents as bags of windows: the highest window of a bag, as ranked
by the network in every second epoch, gets the gradient, and one more window of the clean ones.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LETTERS, release, table

WINDOW, STRIDE = 32, 16
DIM, HIDDEN = 16, 8
WORD_ROWS, GRAM_ROWS = 1 << 13, 1 << 13
#: The classifier is fitted on at most so many toxic and clean documents, and windows of each.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_WINDOWS = 2000, 4000, 16
EPOCHS, BATCH, SEED = 14, 128, 3
#: Words whose inputs a task remembers.
CACHED_WORDS = 100_000
#: Documents at this score or above count as toxic.
THRESHOLD = 0.7


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def grams(word: bytes) -> list[int]:
    w = b"<" + word + b">"
    return [zlib.crc32(w[i : i + 3]) % GRAM_ROWS for i in range(max(1, len(w) - 2))]


Features = tuple[np.ndarray, np.ndarray, np.ndarray]


def features_of(words: list[bytes]) -> Features:
    """Word rows, rows of all trigrams, and the number of trigrams of each word."""
    lists = [grams(w) for w in words]
    return np.array([zlib.crc32(w) % WORD_ROWS for w in words]), np.array([i for g in lists for i in g]), np.array([len(g) for g in lists])


def subset(f: Features, at: np.ndarray) -> Features:
    rows, flat, sizes = f
    n = sizes[at]
    begin = (np.cumsum(sizes) - sizes)[at]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return rows[at], flat[np.repeat(begin, n) + inner], n


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def window_starts(n: int) -> np.ndarray:
    """First words of all windows over n words; the last window ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


class Network:
    """Weights, forward pass and gradients.  Arrays lead with the direction: 0 forward, 1 backward."""

    SHAPES = {
        "word": (WORD_ROWS, DIM), "gram": (GRAM_ROWS, DIM), "wx": (2, DIM, 3 * HIDDEN), "u": (2, HIDDEN, 3 * HIDDEN), "b": (2, 1, 3 * HIDDEN),
        "att": (2, HIDDEN), "out": (2, HIDDEN), "bias": (1,),
    }

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        rng = np.random.default_rng(SEED)
        scale = {"word": 0, "gram": 0.03, "b": 0, "bias": 0, "att": 0.3}
        self.w = weights or {k: (rng.normal(0, scale.get(k, 0.35), s)).astype(np.float32) for k, s in self.SHAPES.items()}

    def inputs(self, f: Features) -> np.ndarray:
        """A vector for each word."""
        rows, flat, sizes = f
        return self.w["word"][rows] + np.add.reduceat(self.w["gram"][flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None].astype(np.float32)

    def states(self, steps: list[np.ndarray], mask: np.ndarray | None, keep: bool = False) -> tuple[np.ndarray, list]:
        """steps: z, r and candidate inputs, each (2, T, N, H), the backward direction in reversed order.
        mask: (2, T, N, 1), 0 where a window has no word.  Returns the states and what the gradients need."""
        u = self.w["u"]
        uz, ur, un = (np.ascontiguousarray(u[:, :, i * HIDDEN : (i + 1) * HIDDEN]) for i in range(3))
        xz, xr, xn = steps
        h = np.zeros((2, *xz.shape[2:]), np.float32)
        out, cache = np.empty_like(xz), []
        for t in range(xz.shape[1]):
            z, r = h @ uz, h @ ur
            z += xz[:, t]
            r += xr[:, t]
            for g in (z, r):
                np.negative(g, out=g)
                np.exp(g, out=g)
                g += 1
                np.reciprocal(g, out=g)
            q = h @ un
            n = r * q
            n += xn[:, t]
            np.tanh(n, out=n)
            new = h - n
            new *= z
            new += n
            if mask is not None:
                new = np.where(mask[:, t] > 0, new, h)
            if keep:
                cache.append((h, z, r, q, n))
            h = out[:, t] = new
        return out, cache

    def pool(self, states: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Attention over words: logits, weights (T, N), and each state's attention and output terms."""
        turned = np.stack([states[0], states[1, ::-1]])
        e = np.einsum("dtnh,dh->tn", turned, self.w["att"])
        o = np.einsum("dtnh,dh->tn", turned, self.w["out"])
        if mask is not None:
            e = np.where(mask[0, :, :, 0] > 0, e, -1e9)
        a = np.exp(e - e.max(axis=0))
        if mask is not None:
            a *= mask[0, :, :, 0]
        a /= np.maximum(a.sum(axis=0), 1e-9)
        return (a * o).sum(axis=0) + self.w["bias"][0], a, o, turned

    def projected(self, x: np.ndarray) -> list[np.ndarray]:
        """Gate inputs of word vectors: z, r, candidate, each (2, words, H)."""
        p = np.matmul(x[None], self.w["wx"]) + self.w["b"]
        return [np.ascontiguousarray(p[:, :, i * HIDDEN : (i + 1) * HIDDEN]) for i in range(3)]

    @staticmethod
    def steps(gates: list[np.ndarray], ids: np.ndarray) -> list[np.ndarray]:
        """Gate inputs of windows ids (N, T)."""
        t = np.ascontiguousarray(ids.T)
        return [np.stack([g[0][t], g[1][t[::-1]]]) for g in gates]

    def logits(self, gates: list[np.ndarray], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.empty(len(ids), np.float32)
        order = np.argsort(lengths, kind="stable")
        for at in range(0, len(ids), 2048):
            i = order[at : at + 2048]
            mask = None if lengths[i].min() >= ids.shape[1] else window_mask(lengths[i], ids.shape[1])
            out[i] = self.pool(self.states(self.steps(gates, ids[i]), mask)[0], mask)[0]
        return out

    def gradients(self, unique: Features, ids: np.ndarray, lengths: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross entropy of windows ids (N, T) over words ``unique``."""
        w, h3 = self.w, HIDDEN
        used, local = np.unique(ids, return_inverse=True)
        local, words = local.reshape(ids.shape), subset(unique, used)
        x = self.inputs(words)
        mask = window_mask(lengths, ids.shape[1])
        states, cache = self.states(self.steps(self.projected(x), local), mask, keep=True)
        logit, a, o, turned = self.pool(states, mask)
        d = ((sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["bias"][0] = d.sum()
        do = a * d
        de = a * (o - (a * o).sum(axis=0)) * d
        g["out"] = np.einsum("tn,dtnh->dh", do, turned)
        g["att"] = np.einsum("tn,dtnh->dh", de, turned)
        dturned = do[None, :, :, None] * w["out"][:, None, None] + de[None, :, :, None] * w["att"][:, None, None]
        dstates = np.stack([dturned[0], dturned[1, ::-1]])
        u, back = w["u"], np.zeros_like(states[:, 0])
        uz, ur, un = (u[:, :, i * h3 : (i + 1) * h3] for i in range(3))
        dpre = np.empty((2, *states.shape[1:3], 3 * h3), np.float32)
        for t in reversed(range(states.shape[1])):
            h, z, r, q, n = cache[t]
            dh = back + dstates[:, t]
            live = mask[:, t]
            dn = dh * (1 - z) * (1 - n * n) * live
            dz = dh * (h - n) * z * (1 - z) * live
            dr = dn * q * r * (1 - r)
            dq = dn * r
            dpre[:, t] = np.concatenate([dz, dr, dn], axis=2)
            ht = h.transpose(0, 2, 1)
            g["u"] += np.concatenate([ht @ dz, ht @ dr, ht @ dq], axis=2)
            back = np.where(live > 0, dh * z, dh) + dz @ uz.transpose(0, 2, 1) + dr @ ur.transpose(0, 2, 1) + dq @ un.transpose(0, 2, 1)
        g["b"] = dpre.sum(axis=(1, 2))[:, None]
        at = local.T
        for k in range(2):
            flat = np.zeros((len(used), 3 * h3), np.float32)
            np.add.at(flat, (at if k == 0 else at[::-1]).ravel(), dpre[k].reshape(-1, 3 * h3))
            g["wx"][k] = x.T @ flat
            dx = flat @ w["wx"][k].T
            np.add.at(g["word"], words[0], dx)
            np.add.at(g["gram"], words[1], np.repeat(dx / words[2][:, None].astype(np.float32), words[2], axis=0))
        return g


def window_mask(lengths: np.ndarray, size: int) -> np.ndarray:
    m = (np.arange(size)[:, None] < lengths[None, :]).astype(np.float32)
    return np.stack([m, m[::-1]])[..., None]


@dataclass
class Model:
    """Weights, and the line that maps the highest window's logit to the document's."""

    weights: dict[str, np.ndarray] | None
    scale: float
    shift: float

    def scores(self, batches):
        """Scores of lists of whole texts."""
        net = Network(self.weights) if self.weights else None
        seen: dict[bytes, int] = {}
        gates = [np.empty((2, 0, HIDDEN), np.float32)] * 3
        for texts in batches:
            if net is None:
                yield np.full(len(texts), sigmoid(np.float64(self.shift)))
                continue
            if len(seen) > CACHED_WORDS:
                seen = {}
            docs = [words_of(t) for t in texts]
            fresh = [w for w in {b""}.union(*docs) if w not in seen]
            if fresh:
                need = len(seen) + len(fresh)
                if need > gates[0].shape[1]:
                    room = [np.empty((2, need + need // 2, HIDDEN), np.float32) for _ in gates]
                    for a, b in zip(room, gates, strict=True):
                        a[:, : len(seen)] = b[:, : len(seen)]
                    gates = room
                for a, b in zip(gates, net.projected(net.inputs(features_of(fresh))), strict=True):
                    a[:, len(seen) : need] = b
                seen.update(zip(fresh, range(len(seen), need), strict=True))
            top = np.empty(len(docs))
            at = 0
            while at < len(docs):  # a hundred thousand words at a time
                upto, n = at, 0
                while upto < len(docs) and (upto == at or n < 100_000):
                    n += len(docs[upto])
                    upto += 1
                top[at:upto] = self._highest(net, gates, seen, docs[at:upto])
                at = upto
            yield sigmoid(self.scale * top + self.shift)

    @staticmethod
    def _highest(net: Network, gates, seen, docs) -> np.ndarray:
        blank = seen[b""]
        flat: list[int] = []
        for d in docs:
            flat.extend(map(seen.__getitem__, d))
            flat.extend([blank] * (WINDOW - len(d)))
        padded = np.array(flat, np.int64)
        sizes = np.array([len(d) for d in docs])
        offsets = np.concatenate(([0], np.cumsum(np.maximum(sizes, WINDOW))))[:-1]
        starts = [window_starts(n) for n in sizes.tolist()]
        counts = np.array([len(s) for s in starts])
        first = np.concatenate(starts) + np.repeat(offsets, counts)
        top = np.full(len(first), -np.inf, np.float32)
        lengths = np.minimum(np.repeat(sizes, counts), WINDOW)
        for at in range(0, len(first), 16384):
            s = slice(at, at + 16384)
            top[s] = net.logits(gates, padded[first[s, None] + np.arange(WINDOW)], lengths[s])
        return np.maximum.reduceat(top, np.cumsum(counts) - counts)


def train(bags: list[tuple[list[bytes], int]]) -> Model:
    """bags: windows (words joined by spaces), and the label, of each document."""
    y = np.array([b[1] for b in bags])
    if len(set(y.tolist())) < 2:
        rate = (y.sum() + 0.1) / (len(y) + 1) if len(y) else 0.05
        return Model(None, 0, float(np.log(rate / (1 - rate))))
    vocabulary: dict[bytes, int] = {b"": 0}
    owner = np.repeat(np.arange(len(bags)), [len(b) for b, _ in bags])
    ids, lengths = np.zeros((len(owner), WINDOW), np.int32), np.zeros(len(owner), np.int64)
    for row, win in enumerate(win for b, _ in bags for win in b):
        words = win.split()
        lengths[row] = len(words)
        ids[row, : len(words)] = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
    unique = features_of(list(vocabulary))
    rng, net = np.random.default_rng(SEED), Network()
    fit = np.ones(len(bags), bool)
    for label in (0, 1):  # a fifth of each label calibrates the threshold
        own = np.flatnonzero(y == label)
        if len(own) >= 20:
            fit[rng.permutation(own)[: len(own) // 5]] = False
    weight = np.where(y == 1, min(4.0, (y[fit] == 0).sum() / max(1, (y[fit] == 1).sum())), 1.0)
    m, v = ({k: np.zeros_like(x) for k, x in net.w.items()} for _ in range(2))
    step = 0
    begin = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(bags)))))
    epochs = EPOCHS if len(owner) > 20_000 else 3 * EPOCHS
    for epoch in range(epochs):
        noise = np.random.default_rng(epoch).random(len(owner))
        if epoch == 0:
            order = np.lexsort((noise, owner))
        elif epoch % 2:
            order = np.lexsort((net.logits(net.projected(net.inputs(unique)), ids, lengths) + 0.01 * noise, owner))
        chosen = order[begin[1:] - 1]
        again = order[begin[:-1] + (noise[: len(bags)] * (begin[1:] - begin[:-1])).astype(int)]
        chosen = np.concatenate((chosen[fit], again[fit & (y == 0)]))
        rng.shuffle(chosen)
        for at in range(0, len(chosen), BATCH):
            i = chosen[at : at + BATCH]
            g = net.gradients(unique, ids[i], lengths[i], y[owner[i]].astype(np.float32), weight[owner[i]])
            step += 1
            for k, x in net.w.items():
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] ** 2 - v[k])
                rate = 0.01 * min(1, 2 * (1 - epoch / epochs))
                x -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)
                if k in ("word", "gram"):
                    x *= 1 - 0.02 * rate
    ranking = net.logits(net.projected(net.inputs(unique)), ids, lengths)
    top = np.maximum.reduceat(ranking, begin[:-1])
    held = ~fit if (~fit & (y == 1)).any() else fit
    #: The threshold halves the gap where errors are fewest; it maps to THRESHOLD.
    s, t = top[held], y[held] == 1
    cuts = np.unique(s)
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    errors = np.array([(t & (s < c)).sum() + (~t & (s >= c)).sum() for c in cuts])
    best = cuts[errors == errors.min()]
    cut = best[np.argmin(np.abs(best - (np.median(s[t]) + np.median(s[~t])) / 2))]
    return Model(net.w, 1.0, float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """From a bounded sample of labelled rows, chosen by hash; never from rows held out."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    picked = None
    for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    picked = F.broadcast(picked)  # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of 12 bytes

    def windows(batches):
        for b in batches:
            out: list = [[], [], []]
            for i, t, y in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                w = words_of(t)
                starts = window_starts(len(w))
                if len(starts) > SAMPLE_WINDOWS:
                    starts = np.sort(np.random.default_rng(i & 0xFFFFFFFF).permutation(starts)[:SAMPLE_WINDOWS])
                out[0].append(i)
                out[1].append([b" ".join(w[s : s + WINDOW]) for s in starts])
                out[2].append(y)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.binary())), pa.array(out[2], pa.int32())], ["doc_id", "windows", "toxic"])
        release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).join(picked, "doc_id")
    # A doc_id that repeats counts once, by its least text.
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic")
    got = rows.mapInArrow(windows, "doc_id long, windows array<binary>, toxic int").toArrow()
    got = sorted(zip(*(got.column(k).to_pylist() for k in range(3)), strict=True), key=lambda r: (r[0], r[1]))
    return train([(r[1], r[2]) for r in got])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs and ``score`` (double, 0 to 1) of each whole text; null and empty texts score as a window without words."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.scale, model.shift))  # about a megabyte, whatever the corpus
    keep = [c for c in docs.columns if c != "score"]

    def run(batches):
        def texts():
            for b in batches:
                for at in range(0, b.num_rows, 250):
                    part = b.slice(at, 250)
                    held.append(part)
                    yield part.column(keep.index("text")).cast(pa.binary()).to_pylist()

        held: list = []
        for s in Model(*shared.value).scores(texts()):
            part = held.pop()
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64())], [*keep, "score"])
        release()

    schema = docs.select(*keep).schema.add("score", "double")
    return docs.select(*keep).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (with columns doc_id and text) plus held_out boolean, score double and predicted int.

    held_out: crc32(doc_id as text) mod 3 is 1 (false for null ids); such labels are never learnt from.
    Labels of a repeated doc_id count as toxic if any is; null labels are ignored; with labels of one kind
    or none, every score is their base rate.  Input columns with the names of the results are replaced.
    """
    model = fit(docs, labels)
    out = score(docs.drop("held_out", "predicted"), model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return out.withColumn("held_out", held).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")
