"""Each operator against a plain version on a small fixture, and on odd inputs."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from aerolayer.llm import boosting, common, decontaminate, htmltext, licenses, linededup, media, mixing, pii, pseudolm, simhash, toxicity

SCHEMA = "doc_id long, text string, source string, extra int"


def words(rng, n, top=400):
    return [f"w{rng.randrange(top)}" for _ in range(n)]


def odd_rows():
    long_text = " ".join(f"long{i % 997} x{i}" for i in range(30_000))
    return [(1, None, "a", 1), (2, "", None, 2), (3, "   \n\t", "b", 3), (4, "one", "b", 4), (5, "same text here", "b", 5), (5, "same text here", "b", 5), (None, "no id at all", "a", 6), (None, None, None, 7), (7, long_text, "a", 8), (8, long_text, "a", 9)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_on_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 40)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == plain_components({x for e in edges for x in e}, edges)


# 1


def test_gradients():
    net = toxicity.Network()
    ws, ids, n = toxicity.features_of([b"abc", b"defg", b"hi", b""]), np.array([[0, 1, 2] + [3] * 29, [2, 2, 1, 0] * 8]), np.array([3, 32])
    y, one = np.array([1.0, 0.0]), np.ones(2)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}

    def loss():
        p = toxicity.sigmoid(net.logits(net.projected(net.inputs(ws)), ids, n).astype(float))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, g in net.gradients(ws, ids, n, y, one).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = net.w[name][at]
        net.w[name][at] = old + 1e-2
        up = loss()
        net.w[name][at] = old - 1e-2
        down = loss()
        net.w[name][at] = old
        assert abs(g[at] - (up - down) / 2e-2) < 1e-3 + 0.02 * abs(g[at]), name


def test_toxicity_learns_and_windows_cover(spark, odd, empty):
    assert all(set(range(n)) <= {i for s in toxicity.window_starts(n) for i in range(s, s + toxicity.WINDOW)} for n in range(1, 200))
    rng = random.Random(1)
    rows = []
    for i in range(900):
        w = words(rng, rng.randint(5, 150))
        if toxic := i % 3 == 0:
            w[rng.randrange(len(w))] = rng.choice(["scumba", "scumki", "scumlo"])
        rows.append((i, " ".join(w), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all((r.score >= 0.7) == (r.predicted == 1) for r in got.values())
    clash = odd.withColumn("score", F.lit("x"))
    out = toxicity.toxicity(clash, labels.limit(0)).collect()
    assert len(out) == 10 and all(0 <= r.score <= 1 for r in out)
    assert toxicity.toxicity(empty, labels.limit(0)).count() == 0
    model = toxicity.train([([b"bad"], 1), ([b"good", b"so good"], 0)] * 30)
    whole = list(model.scores([[r[1].encode() if r[1] is not None else None for r in odd_rows()]]))[0]
    assert whole.shape == (10,) and np.isfinite(whole).all()


def plain_logit(w, words):
    """The network on one window, word by word."""
    h_, sig = toxicity.HIDDEN, lambda x: 1 / (1 + np.exp(-x))
    if not words:
        return float(w["bias"][0])
    x = [w["word"][toxicity.features_of([t])[0][0]] + np.mean([w["gram"][g] for g in toxicity.grams(t)], axis=0) for t in words]
    states = []
    for k in (0, 1):
        h, out = np.zeros(h_), []
        for v in x if k == 0 else x[::-1]:
            g = v @ w["wx"][k] + w["b"][k][0]
            u = [w["u"][k][:, i * h_ : (i + 1) * h_] for i in range(3)]
            z, r = sig(g[:h_] + h @ u[0]), sig(g[h_ : 2 * h_] + h @ u[1])
            n = np.tanh(g[2 * h_ :] + r * (h @ u[2]))
            h = n + z * (h - n)
            out.append(h)
        states.append(out if k == 0 else out[::-1])
    e, o = (np.array([sum(states[k][t] @ w[name][k] for k in (0, 1)) for t in range(len(x))]) for name in ("att", "out"))
    a = np.exp(e - e.max())
    return float((a * o).sum() / a.sum() + w["bias"][0])


def test_scores_are_those_of_every_window_by_itself(monkeypatch):
    rng = random.Random(40)
    net = toxicity.Network()
    noise = np.random.default_rng(41)
    w = {k: (v + noise.normal(0, 0.2, v.shape)).astype(np.float32) for k, v in net.w.items()}
    docs = [" ".join(words(rng, n, 60)).encode() for n in (0, 1, 5, 31, 32, 33, 48, 49, 150)] + [None, b"w1 w1 w1", b"a" * 500]
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 30)  # the cache of words starts anew between batches
    model = toxicity.Model(w, 1.3, -0.4)
    got = np.concatenate(list(model.scores([docs[:4], docs[4:5], docs[5:9], docs[9:], docs])))
    want = []
    for t in docs:
        ws = toxicity.words_of(t)
        top = max(plain_logit(w, ws[s : s + toxicity.WINDOW]) for s in toxicity.window_starts(len(ws)))
        want.append(1 / (1 + np.exp(-(1.3 * top - 0.4))))
    assert np.allclose(got, want + want, atol=1e-4)
    assert all(set(range(n)) == {j for s in toxicity.window_starts(n) for j in range(s, min(n, s + toxicity.WINDOW))} for n in range(1, 200))


# 2


def plain_tiles(d, t, shortest):
    d, t, out = list(d), list(t), 0
    while True:
        best = (shortest - 1, 0, 0)
        for i in range(len(d)):
            for j in range(len(t)):
                n = 0
                while i + n < len(d) and j + n < len(t) and d[i + n] == t[j + n] and d[i + n] >= 0:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < shortest:
            return out
        for x in range(n):
            d[i + x], t[j + x] = -1, -2
        out += n


def test_tiling_covers_as_much_as_plain_greedy():
    rng = np.random.default_rng(0)
    for _ in range(150):
        d, t = rng.integers(0, 6, rng.integers(0, 40)), rng.integers(0, 6, rng.integers(1, 15))
        got = decontaminate.tiles(d.astype(np.int64), t.astype(np.int64), 3)
        assert all((d[i : i + n] == t[j : j + n]).all() for i, j, n in got)
        used = [x for _, j, n in got for x in range(j, j + n)]
        assert len(used) == len(set(used))
        assert len(used) == plain_tiles(d, t, 3)
        longest = max((n for *_, n in got), default=0)
        assert longest == max((n for n in range(3, 16) for i in range(len(d) - n + 1) for j in range(len(t) - n + 1) if (d[i : i + n] == t[j : j + n]).all()), default=0)


def test_leaks(spark, odd, empty):
    rng = random.Random(2)
    items = [(i, " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(20))) for i in range(30)] + [(98, "..."), (99, None)]
    filler = lambda n: " ".join("".join(rng.choices("klmnopq", k=5)) for _ in range(n))
    w = items[4][1].split()
    docs = [(1, filler(50)), (2, filler(9) + " " + items[3][1].upper() + ". " + filler(9)), (3, " ".join(w[12:] + [filler(5)] + w[:12])), (4, " ".join(w[:12])), (5, None), (None, items[3][1])]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(2, 3), (3, 4)}
    bench = spark.createDataFrame(items[:2], "item_id long, text string")
    assert decontaminate.decontaminate(odd, bench).count() == 10 and decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.leaks(odd, bench.limit(0)).count() == 0
    clash = odd.withColumns({"seeds": F.lit(1), "item": F.lit(2), "size": F.lit("x"), "item_id": F.lit(3)})
    assert decontaminate.leaks(clash, bench.withColumn("seed", F.lit(0))).count() == 0
    assert decontaminate.decontaminate(clash, bench).columns == clash.columns


def test_digits_tell_items_apart(spark):
    items = [(1, "John has 7 apples and 9 pears how many has he in all"), (2, "12 7 55 81 9 3 16 4")]
    docs = [(1, "John has 2 apples and 3 pears how many has he in all"), (2, "so 12, 7, 55, 81; 9 3 16 4 it is"), (3, items[0][1]), (3, items[0][1]), (4, "12 7 55 80 9 3 17 4"), (5, "9 pears how many has he in all and John has 7 apples")]
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(2, 2), (3, 1), (3, 1), (5, 1)]


def test_leaks_are_those_of_tiling_every_pair(spark):
    rng = random.Random(12)
    text = lambda n: " ".join(f"t{rng.randrange(25)}" for _ in range(n))
    items = [(i, text(rng.randint(1, 12))) for i in range(25)]
    docs = []
    for i in range(120):
        t = text(rng.randint(0, 60)).split()
        if i % 3 == 0:
            own = rng.choice(items)[1].split()
            cut = rng.randrange(len(own) + 1)
            t[len(t) // 2 : len(t) // 2] = own[cut:] + ["x"] * (i % 2) + own[:cut]
        docs.append((i, " ".join(t)))
    number = {}
    codes = lambda t: [number.setdefault(w, len(number)) for w in t.split()]
    want = {(d, i) for d, t in docs for i, w in items if plain_tiles(codes(t), codes(w), min(3, len(codes(w)))) >= 0.8 * len(codes(w))}
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and want


# 3


def test_subset_sum_is_optimal():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths, counts, budget = np.unique(rng.integers(1, 30, 4)), None, int(rng.integers(1, 120))
        counts = rng.integers(0, 4, len(lengths))
        take = mixing.subset_sum(lengths, counts, budget)
        best = max((s for s in (sum(n * c for n, c in zip(lengths.tolist(), p)) for p in np.ndindex(*(counts + 1))) if s <= budget), default=0)
        assert (take <= counts).all() and (take * lengths).sum() == best


def test_budgets_of_long_documents_are_met():
    one = [1] * 3
    for lengths, counts, budget, most in (
        ([70_000, 90_000], one[:2], 96_000, 90_000), ([70_000, 90_000, 400_000], one, 99_000, 90_000), ([97_000, 120_000], one[:2], 96_000, 0),
        ([130_000, 200_000, 300_000], one, 330_000, 330_000), ([70_000, 150_000], [3, 1], 220_000, 220_000), ([0, 5], [9, 1], 4, 0),
    ):
        take = mixing.partial_pass(np.array(lengths), np.array(counts), budget)
        assert (take <= counts).all() and int((take * lengths).sum()) == most


def test_budgets_in_units_come_near(monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(mixing, "SUMS", 256)
    for _ in range(40):
        lengths = np.unique(rng.integers(1, 4000, 6))
        counts = rng.integers(0, 4, len(lengths))
        budget = int(rng.integers(1, 1 + int((lengths * counts).sum())))
        take = mixing.partial_pass(lengths, counts, budget)
        best = max(s for s in (int((lengths * p).sum()) for p in np.ndindex(*(counts + 1))) if s <= budget)
        got = int((take * lengths).sum())
        assert (take <= counts).all() and got <= budget and got >= best - counts.sum() * (budget / 256 + 1)


def test_mix(spark, odd, empty):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.randint(0, 80))), ["b", "a", None, "tiny"][i % 4 if i < 400 else 0], 0) for i in range(1500)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    again = {r.doc_id: r.taken for r in mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7)).collect()}
    assert {r.doc_id: r.taken for r in got} == again
    per = {}
    for r in got:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", rows[r.doc_id][1]))
        assert r.size == n and r.taken % max(1, n) == 0 and r.taken <= 3 * n
        per.setdefault(r.source, [r.target, 0, r.source_size])[1] += r.taken
    assert all(abs(t - x) <= max(2, 0.001 * t) for t, x, _ in per.values())
    assert abs(sum(t for t, *_ in per.values()) - sum(n for *_, n in per.values())) < 1e-6
    assert mixing.mix(odd).count() == 10 and mixing.mix(empty).count() == 0
    assert mixing.water_fill([10, 1000, 10], [5, 2, 1]) == pytest.approx([30, 960, 30])


# 4


def test_pseudo_likelihood(spark, odd, empty, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, rng.randint(0, 60), 50)), "a", 0) for i in range(200)]
    got = {r.doc_id: r for r in pseudolm.log_likelihood(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    hashed, sizes = pseudolm.Words()([r[1].encode() for r in rows])
    flat = pseudolm.buckets(hashed)
    v = pseudolm.Vocabulary.of(np.bincount(flat, minlength=pseudolm.BUCKETS).astype(float))
    ids = pseudolm.cell_ids(v.class_of[flat].astype(np.int64), sizes)
    net = pseudolm.train(*np.unique(ids, return_counts=True))
    # Word by word: the network's own softmax over classes, the share of the bucket in its class, and the same context elsewhere.
    docs = [["", *r[1].split(), ""] for r in rows]
    between = Counter((d[j - 1], d[j + 1]) for d in docs for j in range(1, len(d) - 1))
    triples = Counter(tuple(d[j - 1 : j + 2]) for d in docs for j in range(1, len(d) - 1))
    assert max(between.values()) > 5
    at = 0
    for i, (n, r) in enumerate(zip(sizes.tolist(), rows, strict=True)):
        total, cls = 0.0, v.class_of[flat[at : at + n]].astype(int).tolist()
        for j in range(n):
            c = [cls[j + d] if 0 <= j + d < n else 32 for d in (-2, -1, 1, 2)]
            far = [c[0] * 8 // 32 if c[0] < 32 else 8, c[1], c[2], c[3] * 8 // 32 if c[3] < 32 else 8]
            z = net.hidden(tuple(np.array([x]) for x in far))[0] @ net.w["out"] + net.w["bias"]
            p = np.exp(z[cls[j]] - np.log(np.exp(z).sum()) + v.within[flat[at + j]])
            l, w, r_ = docs[i][j : j + 3]
            total += np.log((triples[l, w, r_] - 1 + pseudolm.PRIOR * p) / (between[l, r_] - 1 + pseudolm.PRIOR))
        assert got[i].n_tokens == n and abs(got[i].log_likelihood - total) < 1e-2
        at += n
    table = net.table().reshape(-1, 32)
    assert np.allclose(np.exp(table).sum(axis=1), 1, atol=1e-4)
    mass = np.bincount(v.class_of, weights=np.exp(v.within.astype(float)))
    assert np.allclose(mass, 1, atol=1e-3)
    monkeypatch.setattr(pseudolm, "PART_WORDS", 40)  # heavy parts, scored in several tasks
    again = {r.doc_id: r.log_likelihood for r in pseudolm.log_likelihood(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()}
    assert all(abs(again[i] - r.log_likelihood) < 1e-2 for i, r in got.items())
    monkeypatch.undo()
    out = pseudolm.log_likelihood(odd.withColumn("part", F.lit("x"))).collect()
    assert len(out) == 10 and sorted((r.n_tokens for r in out))[:4] == [0, 0, 0, 0] and pseudolm.log_likelihood(empty).count() == 0


def test_words_are_hashed_without_python_word_by_word(monkeypatch):
    rng, called = random.Random(6), []
    one = pseudolm.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(pseudolm.xxhash, "xxh3_64_intdigest", lambda w: called.append(w) or one(w))
    pool = [b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b"\x1c", b"\x85", b"\0", b"a", b"A", b"b", "\u00e9".encode(), b"wxyz" * 3, b"q" * 31]
    texts = [None, b"", b" \n ", b"a\0", b"a", b"x" * 64, b"X" * 65, b"x" * 65, b"z " * 5]
    texts += [b"".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(500)]
    split = [(t or b"").lower().split() for t in texts]
    hashed, sizes = pseudolm.Words()(texts)
    assert sizes.tolist() == [len(d) for d in split] and len(hashed) == sizes.sum()
    pairs = set(zip((w for d in split for w in d), hashed.tolist(), strict=True))
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs}) > 500
    assert called and all(len(w) > 64 for w in called)
    many, _ = pseudolm.Words()([b" ".join(b"w%d" % i for i in range(200_000))])
    for bits in (pseudolm.buckets(many), many >> np.uint64(46)):  # both ends are spread evenly
        n = np.bincount(bits.astype(np.int64), minlength=1 << 18)
        assert 0.9 < n.var() / n.mean() < 1.1


def test_sums_travel_by_turns_not_by_rows(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, 40, 30))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    out = pseudolm.log_likelihood(df)
    out.write.format("noop").mode("overwrite").save()
    assert "HashAggregate" not in out._jdf.queryExecution().toString()  # no row for each document and part meets in a sum
    assert out.count() == 400


def test_entries_travel_by_turns_not_by_arrow_batches(spark, monkeypatch):
    rng = random.Random(7)
    df = spark.createDataFrame([(i, " ".join(words(rng, 20, 400))) for i in range(400)], "doc_id long, text string").coalesce(1)
    sent, batches = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    plain = type(df).mapInArrow

    def counted(self, function, schema, *rest):
        def run(given):
            for b in function(given):
                if "blob" in schema:
                    sent.add(b.num_rows)
                    batches.add(1)
                yield b

        return plain(self, run, schema, *rest)

    monkeypatch.setattr(type(df), "mapInArrow", counted)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")  # 40 batches
    try:
        assert len(pseudolm.log_likelihood(df).collect()) == 400
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    # One turn: an entry blob and an answer for each of 32 parts, the tables, cells in 64 parts twice, and the rows' own sums twice.
    assert sent.value <= 4 * 32 + 2 * 64 + 2 and batches.value <= sent.value / 2


def test_texts_that_occur_twice_and_neighbours_within_a_class(spark):
    rng = random.Random(15)
    rows = [(i, " ".join(words(rng, 40, 3000))) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(30)]
    got = {r.doc_id: r.mean_log_likelihood for r in pseudolm.log_likelihood(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert min(got[i] for i in range(30)) > max(got[i] for i in range(30, 300)) + 1
    # Words that are rare alike, in contexts whose classes are alike: the neighbours decide.
    rows = [(i, f"in blue{i % 20} sky{i % 20} over") for i in range(200)] + [(1000, "in blue3 sky3 over"), (1001, "in blue3 sky4 over")]
    got = {r.doc_id: r.log_likelihood for r in pseudolm.log_likelihood(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1000] > got[1001] + 2


# 5


def plain_fingerprint(text, k):
    w = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) > k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, odd, empty):
    rng = random.Random(6)
    rows = []
    for i in range(260):
        w = words(rng, rng.randint(0, 40), 5000)
        if rows and rng.random() < 0.5:
            w = rng.choice(rows)[1].split()
            if w and rng.random() < 0.7:
                w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w).replace("w1", "W1"), "a", 0))
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    fp = {i: plain_fingerprint(t, 3) for i, t, *_ in rows}
    assert all(got[i].fingerprint == f"{f:016x}" for i, f in fp.items())
    comp = plain_components(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3])
    assert {i: r.component_id for i, r in got.items()} == comp
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == 10 and {r.component_id for r in out if r.fingerprint == "0" * 16} == {1}
    assert simhash.near_duplicates(empty).count() == 0


def test_trees_find_every_link():
    rng = np.random.default_rng(7)
    f = rng.integers(0, 2**63, 6000, np.uint64)
    near = f[:3000].copy()
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, 3000, np.uint64)
    f = np.unique(np.concatenate([f, near, f[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))]))
    pairs = [(i, i + 1 + j) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= 3).tolist()]
    found = simhash.links(f, 3)
    linked = [(int(a), int(b)) for x, y in found for a, b in zip(x, y, strict=True)]
    assert plain_components(range(len(f)), linked) == plain_components(range(len(f)), pairs)
    tree = simhash.grow(f[::5], 3, 3, np.random.default_rng(1))
    rows, shards = simhash.route(tree, f, 3)
    at = {}
    for r, s in zip(rows.tolist(), shards.tolist(), strict=True):
        at.setdefault(r, set()).add(s)
    assert all(at[a] & at[b] for a, b in pairs)


def plain_near_groups(rows):
    def shingles(t):
        w = re.sub(r"[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
        return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    s = {i: shingles(t) for i, t in rows}
    return plain_components(s, [(a, b) for a in s for b in s if a < b and len(s[a] & s[b]) >= 0.8 * len(s[a] | s[b])])


def test_near_duplicates_keep_one(spark, odd, empty, monkeypatch):
    rng = random.Random(8)
    rows, base = [], words(rng, 120, 10**6)
    for i in range(300):
        w = words(rng, rng.randint(0, 200), 10**6)
        if i % 3 == 0:
            w = list(base)  # a hot group of near copies
            w[rng.randrange(120)] = f"c{i}"
        elif i % 5 == 0 and rows:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame([(*r, "a", 0) for r in rows], SCHEMA)
    comp = plain_near_groups(rows)
    assert {r.doc_id for r in simhash.drop_near_duplicates(df).collect()} == set(comp.values())
    monkeypatch.setattr(simhash, "CHUNK", 16)  # several levels of chunks
    assert {r.doc_id for r in simhash.drop_near_duplicates(df).collect()} == set(comp.values())
    kept = simhash.drop_near_duplicates(odd)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 4, 5, 5, 7] and kept.where("doc_id is null").count() == 2
    assert kept.columns == odd.columns and simhash.drop_near_duplicates(empty).count() == 0


def bridged_copies():
    """A text, copies with one edit, and copies of those with two more, which hold to one copy each and not to the text."""
    rng = random.Random(12)
    base = words(rng, 120, 10**6)
    rows = [(0, " ".join(base))]
    for i in range(1, 161):
        w, at = list(base), 10 + rng.randrange(95)
        w[at] = f"x{i}"
        rows.append((i, " ".join(w)))
        for p in rng.sample([p for p in range(5, 115, 6) if abs(p - at) > 5], 2):
            w[p] = f"y{i}p{p}"
        rows.append((1000 + i, " ".join(w)))
    return rows


def test_near_duplicates_in_a_hot_group_around_the_limit(spark):
    rows = bridged_copies()
    df = spark.createDataFrame([(*r, "a", 0) for r in rows], SCHEMA)
    assert {r.doc_id for r in simhash.drop_near_duplicates(df).collect()} == set(plain_near_groups(rows).values())


def test_near_duplicates_between_followers_of_chunks(spark, monkeypatch):
    rows = bridged_copies()
    df = spark.createDataFrame([(*r, "a", 0) for r in rows], SCHEMA)
    monkeypatch.setattr(simhash, "CHUNK", 16)
    assert {r.doc_id for r in simhash.drop_near_duplicates(df).collect()} == set(plain_near_groups(rows).values())


def quick_near_groups(rows):
    """plain_near_groups by an index of shingles, for many rows."""
    sets, index = {}, {}
    for i, t in rows:
        w = t.lower().encode().split()
        sets[i] = {b" ".join(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
    pairs = []
    for i, own in sets.items():
        # Two sets at 0.8 share all but a fifth of the smaller: a prefix of over a fifth in any fixed order meets.
        head = sorted(own, key=lambda x: zlib.crc32(x))[: len(own) - math.ceil(0.8 * len(own)) + 1]
        seen = set().union(*(index.get(x, ()) for x in head))
        pairs += [(j, i) for j in seen if len(sets[j] & own) >= 0.8 * len(sets[j] | own)]
        for x in head:
            index.setdefault(x, []).append(i)
    return plain_components(sets, pairs), pairs


def test_near_duplicates_of_five_thousand_texts(spark, monkeypatch):
    rng = random.Random(31)
    rows, bases = [], [words(rng, n, 10**6) for n in (60, 90, 150, 300)]
    for i in range(5000):
        if i % 10 < 6:
            w = list(bases[i % 4])  # hot groups, spread around the limit
            for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5, 8])):
                w[rng.randrange(len(w))] = f"c{rng.randrange(10**6)}"
        else:
            w = words(rng, rng.randint(0, 60), 10**5)
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(simhash, "CHUNK", 256)
    monkeypatch.setattr(simhash, "SHARD", 256)
    groups, pairs = quick_near_groups(rows)
    assert len(pairs) > 10_000
    df = spark.createDataFrame([(*r, "a", 0) for r in rows], SCHEMA).repartition(8)
    scratch = common.Scratch(spark, "t")
    got = {r.doc_id: r.component_id for r in simhash.similar_classes(df, scratch).collect()}
    joined = np.mean([got[a] == got[b] for a, b in pairs])
    assert joined >= 0.99 and all(groups[i] == groups[c] for i, c in got.items())
    assert got == groups


def test_rows_of_a_hot_group_grow_with_its_members(spark, monkeypatch):
    rng = random.Random(17)
    base, rows = words(rng, 200, 10**6), []
    for i in range(200):  # copies about 0.74 alike: members of one group, but mostly not linked
        w = list(base)
        for p in rng.sample(range(200), 3):
            w[p] = f"c{i}p{p}"
        rows.append((i, " ".join(w)))
    for i in range(0, 200, 20):
        w = rows[i][1].split()
        w[100] = f"d{i}"
        rows.append((1000 + i, " ".join(w)))
    written, write = {}, common.Scratch.write

    def counted(self, df, label):
        out = write(self, df, label)
        written[label] = max(out.count(), written.get(label, 0))
        return out

    monkeypatch.setattr(common.Scratch, "write", counted)
    df = spark.createDataFrame([(*r, "a", 0) for r in rows], SCHEMA)
    got = {r.doc_id: r.component_id for r in simhash.similar_classes(df, common.Scratch(spark, "t")).collect()}
    assert got == quick_near_groups(rows)[0]
    assert written["left"] <= (simhash.BANDS + 1) * len(rows), written


def test_large_shards_are_parted_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 64)
    rng = np.random.default_rng(17)
    f = rng.integers(0, 2**63, 3000, np.uint64)
    ball = np.array([int(f[0]) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (600, 2))], np.uint64)
    near = f[:800] ^ (np.uint64(1) << rng.integers(0, 63, 800, np.uint64))
    f = np.unique(np.concatenate([f, ball, near])).view(np.int64)
    rows = spark.createDataFrame([(int(x), i) for i, x in enumerate(f)], "fp long, rep long")
    got = [(r.a, r.b) for r in simhash.link_fingerprints(rows, 3).collect()]
    u = f.view(np.uint64)
    pairs = [(i, i + 1 + j) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= 3).tolist()]
    assert plain_components(range(len(u)), got) == plain_components(range(len(u)), pairs)


# 6


def plain_line_dedup(rows, least):
    docs = {d: t.split("\n") for d, t in sorted(rows)}
    order = [(d, p) for d in docs for p in range(len(docs[d]))]
    gone = set()
    for i, (d, p) in enumerate(order):
        best = 0
        for e, q in order[:i]:
            n = 0
            while p + n < len(docs[d]) and q + n < len(docs[e]) and docs[d][p + n] == docs[e][q + n]:
                n += 1
            best = max(best, n)
        if sum(len(x.split()) for x in docs[d][p : p + best]) > least:
            gone |= {(d, p + x) for x in range(best)}
    return {d: "\n".join(x for p, x in enumerate(v) if (d, p) not in gone) for d, v in docs.items()}


def test_line_dedup(spark, odd, empty):
    rng = random.Random(9)
    lines = [" ".join(["w"] * rng.randint(0, 25)) + str(i) for i in range(12)]
    rows = []
    for d in range(50):
        t = [rng.choice(lines) for _ in range(rng.randint(0, 9))]
        if rows and rng.random() < 0.5:
            base = rng.choice(rows)[1].split("\n")
            a = rng.randrange(len(base))
            t = t[:2] + base[a : a + rng.randint(1, 12)] + t[2:4]
        rows.append((d, "\n".join(t)))
    got = linededup.deduplicate_lines(spark.createDataFrame([(*r, "a", 0) for r in rows], SCHEMA)).collect()
    assert {r.doc_id: r.text for r in got} == plain_line_dedup(rows, 50)
    assert all(r.n_lines == rows[r.doc_id][1].count("\n") + 1 for r in got)
    out = linededup.deduplicate_lines(odd.withColumn("removed", F.lit(1))).collect()
    by = {r.doc_id: r for r in out if r.doc_id}
    assert len(out) == 10 and by[8].text == "" and by[8].removed == "0-1" and by[7].removed == "" and by[5].text == "same text here"
    assert linededup.deduplicate_lines(empty).count() == 0


# 7


def test_lines_are_named_without_batches_of_texts(spark):
    texts = {1: "a\n\nb c\r\n", 2: "", 3: "\n", 4: "Grüße 𝄞\x00\nx\u2028y\u0085z", 5: None}
    df = spark.createDataFrame([*texts.items(), (None, "a")], "doc_id long, text string")
    want = set()
    for i, t in texts.items():
        for p, x in enumerate(t.encode().split(b"\n") if t is not None else []):
            h = np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)
            want.add((i, int(h), p, *np.frombuffer(hashlib.md5(x).digest(), ">i8").tolist()))
    lines = linededup.line_table(df)
    assert {tuple(r) for r in lines.collect()} == want
    assert "Arrow" not in lines._jdf.queryExecution().toString()  # no worker holds a batch of whole texts


def test_media(spark, odd, empty, tmp_path):
    got = media.media_columns(odd).collect()
    assert len(got) == 10
    texts = {r[0]: (r[1] or "").encode() for r in odd_rows() if r[0]}
    for r in got:
        if r.doc_id:
            p = media.padded(texts[r.doc_id])
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(texts[r.doc_id]), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
            assert r.media_sha256 == hashlib.sha256(media.encode_png(p)).hexdigest()
    assert len({(r.media_sha256, r.feature) for r in got if r.doc_id in (1, 2)}) == 1
    assert media.media_columns(empty).count() == 0
    folder = "file://" + str(tmp_path / "a")
    assert len(media.store(odd.coalesce(1), folder, archive_bytes=1000)) > 1
    spark.dataSource.register(media.ArchiveSource)
    small = spark.read.format("media_archive").option("rangeBytes", 300).load(folder)
    assert small.count() == 10
    import zipfile

    name = sorted((tmp_path / "a").iterdir())[0]
    with zipfile.ZipFile(name) as z:  # other tools can read it
        assert z.testzip() is None and len(z.namelist()) >= 1


def test_members_are_retried(tmp_path):
    w = media.ArchiveWriter("file://" + str(tmp_path / "a.zip"))
    for i in range(3):
        w.add(f"{i}_1.png", bytes([i]) * 100)
    w.close()
    reader = media.ArchiveReader({"path": "file://" + str(tmp_path)})
    part, failures = reader.partitions()[0], []
    plain = media.read_member

    def flaky(f, name, *rest):
        if name == "1_1.png" and len(failures) < 2:
            failures.append(name)
            raise OSError("lost")
        return plain(f, name, *rest)

    media.read_member = flaky
    try:
        got = [b for batch in reader.read(part) for b in batch.column(3).to_pylist()]
    finally:
        media.read_member = plain
    assert got == [bytes([i]) * 100 for i in range(3)] and len(failures) == 2


# 8


def test_html_on_unseen_pages():
    rng, model = np.random.default_rng(999), htmltext.train()
    right = [htmltext.extract([p], model)[0] == main for p, main in (htmltext.generated_page(rng) for _ in range(150))]
    assert np.mean(right) > 0.8


def test_html_parsing(spark, empty):
    page = "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/x>Home</a></ul></nav><article><h1>A &amp; B &lt;c&gt;</h1><p>First  <b>bold</b><br>line.<p>Second &copy; one &#233;.</article><footer>&copy; foot</footer></body></html>"
    blocks = [htmltext.clean(n.text) for n in htmltext.describe(htmltext.parse(page))[0] if n.tag == "#text"]
    assert blocks == ["Home", "A & B <c>", "First bold line.", "Second © one é.", "© foot"]
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<div class='" + "x" * 5000), (6, "u", "<p>" * 3000 + "deep")]
    got = {r.page_id: r for r in htmltext.main_text(spark.createDataFrame(rows, "page_id long, text string, html string")).collect()}
    assert got[1].text == "A & B <c>\n\nFirst bold line.\n\nSecond © one é." and got[2].text == got[3].text == ""
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_sibling_shares_count_all_siblings():
    nodes, x = htmltext.describe(htmltext.parse("<div>" + "<p>a b</p>" * 60 + "<ul>c</ul>" * 40 + "</div>"))
    share = {n.tag: x[i, 11] for i, n in enumerate(nodes)}
    assert share["p"] == pytest.approx(0.6) and share["ul"] == pytest.approx(0.4)


def test_decoding_is_consistent_and_best():
    rng = np.random.default_rng(1)
    for _ in range(40):
        root = htmltext.Node("html", "", None)
        nodes = [root]
        for _ in range(rng.integers(1, 9)):
            nodes.append(htmltext.Node("div", "", nodes[rng.integers(len(nodes))]))
        flat, _ = htmltext.describe(root)
        z = rng.normal(0, 2, len(flat))
        kept = htmltext.decode(flat, z)
        at = {id(n): i for i, n in enumerate(flat)}
        legal = lambda m: m[0] and all(m[at[id(n.parent)]] or not m[i] for i, n in enumerate(flat) if n.parent)  # noqa: B023,E731
        value = lambda m: sum(np.clip(s, -6, 6) if b else -np.clip(s, -6, 6) for s, b in zip(z, m, strict=True))  # noqa: B023,E731
        best = max(value(m) for m in ([bool(x >> i & 1) for i in range(len(flat))] for x in range(2 ** len(flat))) if legal(m))
        assert legal(kept) and value(kept) == pytest.approx(best)


def test_pages_by_hand():
    model = htmltext.train()
    story = ["The river rose again", "Heavy rain fell over the hills on Monday, and by noon the river had left its banks.", "Farmers moved their cattle to higher ground, as they had done in years before.", "No one was hurt, the mayor said, but two bridges will stay closed until the water falls."]
    p = "".join(f"<p>{x}</p>" for x in story[1:])
    menu = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>Sport</a></li></ul>"
    note = "<div class='cookie-notice'>We use cookies on this site.</div>"
    pages = [
        f"<html><body><nav>{menu}</nav><article><h1>{story[0]}</h1>{p}</article><footer>&copy; The Paper</footer></body></html>",
        f"<html><body><header><div class=top>The Paper</div>{menu}</header>{note}<main><article class=story><h1>{story[0]}</h1>{p}</article></main><aside><h3>Related</h3>{menu}</aside><footer>All rights reserved</footer></body></html>",
        f"<html><head><script>var a='<p>x</p>'</script></head><body><div id=nav>{menu}</div><div id=content><h1>{story[0]}</h1>{p}<div class=advert>Buy now</div></div><div class=sidebar>{menu}</div></body></html>",
        f"<html><body><form><input><button>Search</button></form><article><h1>{story[0]}</h1>{p}<section class=comments><div class=comment><p>I saw it too, it was wide.</p></div></section></article></body></html>",
        f"<html><head><title>no end<body><svg><path d='M0'><nav>{menu}</nav><article><h1>{story[0]}</h1>{p}</article></body></html>",
        f"<html><body><!-- {menu} --><nav>{menu}</nav><article><h1>{story[0]}</h1><P>{story[1]}<P>{story[2]}<P>{story[3]}</article><select><option>a<footer>The Paper</footer></body></html>",
    ]
    assert htmltext.extract(pages, model) == ["\n\n".join(story)] * len(pages)


def test_letters_that_grow_in_lower_case_and_odd_pages(spark):
    text = "The main story goes on for a while, with many words in it, and it has an end."
    page = f"<html><body><article><p>{'\u0130' * 12}</p><p>{text}</p><SCRIPT>x</sCript><p>{text}</p></article></body></html>"
    assert htmltext.extract([page], htmltext.train())[0] == f"{'\u0130' * 12}\n\n{text}\n\n{text}"
    long_page = "<html><body><article>" + f"<p>{text}</p>" * 3000 + "<svg>" * 20000 + "</article></body></html>"
    rows = [(1, page, 5), (1, page, 5), (2, long_page, None), (3, "<svg>" * 50_000, 1), (4, "<" * 50_000, 1)]
    got = htmltext.main_text(spark.createDataFrame(rows, "page_id long, html string, text int")).collect()
    assert len(got) == 5 and [r.text for r in got if r.page_id == 1] == [htmltext.extract([page], htmltext.train())[0]] * 2
    assert next(r.n_chars for r in got if r.page_id == 2) == 3000 * (len(text) + 2) - 2


# 9


def test_licenses(spark, empty):
    files = [
        ("a/LICENSE", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
        ("a/b/x.py", "# Licensed under the Apache License, Version 2.0.\nimport y"),
        ("a/b/c/y.py", "print(1)"),
        ("a/b/c/z.py", None),
        ("d/e.txt", ""),
        ("top.txt", "mit the und der mit"),
        ("d/LICENSE", "nothing of note"),
        (None, "Released under the MIT License."),
    ]
    got = {r.path: (r.license, r.origin, r.licence_dir) for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["a/b/x.py"] == ("Apache-2.0", "own", None) and got["a/LICENSE"][:2] == ("MIT", "own")
    assert got["a/b/c/y.py"] == got["a/b/c/z.py"] == ("MIT", "inherited", "a")
    assert got["d/e.txt"] == got["top.txt"] == got["d/LICENSE"] == (None, "none", None) and None in got
    assert licenses.scan(empty.select(F.lit("x").alias("path"), "text")).count() == 0


def test_licences_by_other_words_and_odd_files(spark):
    long_text = "plain words go on and on\n" * 40_000 + "Released under the MIT License.\n"
    files = [("a.py", "# Distributed under the GNU GPL v3", 1), ("b.py", "Apache 2.0", 2), ("c.py", "copyright of nobody but the wind and the long road home", 3), ("d.txt", long_text, 4), ("d.txt", long_text, 4), ("e.txt", None, None), (None, None, None)]
    df = spark.createDataFrame(files, "path string, text string, extra int").withColumns({"license": F.lit("x"), "sid": F.lit(1), "dir": F.lit("y"), "similarity": F.lit("z")})
    got = licenses.scan(df).collect()
    assert len(got) == 7 and [r.license for r in got if r.path == "d.txt"] == ["MIT", "MIT"]
    own = {r.path: r.license for r in got}
    assert own["a.py"] == "GPL-3.0" and own["b.py"] == "Apache-2.0" and own["c.py"] is None and own["e.txt"] is None


def test_cosines_against_plain(spark, tmp_path):
    texts = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3", "licensed to nobody for anything at all"]
    found = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, statement string")
    found = found.withColumn("sid", F.md5("statement"))
    known = licenses.recognised(found, common.Scratch(spark, "t")).join(found, "sid")
    got = {r.statement: (r.license, r.similarity) for r in known.collect()}
    split = lambda t: [w for w in re.split(r"[^a-z0-9]+", t.lower()) if w]
    all_ = [split(t) for t in texts] + [split(t) for _, t in licenses.TEMPLATES]
    idf = {w: np.log((1 + len(all_)) / (1 + sum(w in x for x in all_))) + 1 for x in all_ for w in x}

    def vector(ws):
        v = {w: ws.count(w) * idf[w] for w in ws}
        n = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / n for w, x in v.items()}

    for t in texts:
        a = vector(split(t))
        best = max(sum(x * b.get(w, 0) for w, x in a.items()) for b in (vector(split(u)) for _, u in licenses.TEMPLATES))
        assert (t in got) == (best >= 0.5) and (t not in got or abs(got[t][1] - best) < 1e-6)


# 10

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    def luhn(n):
        return sum((int(c) * (1 + i % 2)) // 10 + (int(c) * (1 + i % 2)) % 10 for i, c in enumerate(reversed(n))) % 10 == 0

    def ok(k, m):
        n = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": k != "ip" or all(int(p) <= 255 for p in m.split(".")), "card": 13 <= len(n) <= 19 and luhn(n), "phone": 9 <= len(n) <= 15}[k]

    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, t) if ok(k, m.group()))


def test_terms_are_counted_in_a_row(spark):
    texts = ["", "--", "b a, A b;b 1", "The MIT License, the MIT license"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: {x.term: x.tf for x in r.c or []} for r in df.select("i", licenses.term_counts(F.col("text")).alias("c")).collect()}
    assert got == {i: dict(Counter(w for w in re.split("[^a-z0-9]+", t.lower()) if w)) for i, t in enumerate(texts)}


def test_no_digest_is_written_for_each_term(spark, monkeypatch):
    written, write = {}, common.Scratch.write

    def kept(self, df, label):
        written[label] = out = write(self, df, label)
        return out

    monkeypatch.setattr(common.Scratch, "write", kept)
    rows = [("a", "Released under the MIT License, and many other words of mine besides")]
    assert licenses.scan(spark.createDataFrame(rows, "path string, text string")).count() == 1
    assert all(t.count() <= 1 for t in written.values() if "sid" in t.columns)


def test_base_spans(spark, odd, empty):
    rng = random.Random(10)
    parts = ["a.b@c.d", "x@y", "@", "1.2.3.4", "300.1.1.1", "007.08.0.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (873) 555-4781", "+12", "é𝄞", "a@b.co_x@d.ee", "12.34", " ", "\n", "word", ".", "5", "000000000000000000000000000001.1.1.1"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows += [(900, "1.1.1.1 " * 1000), (901, "1" * 20000), (902, "a@b.c" * 400)]
    df = spark.createDataFrame([(*r, "a", 0) for r in rows], SCHEMA)
    for r in pii.personal_data(df.withColumn("spans", F.lit(0))).collect():
        want = plain_spans(r.text)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.spans.startswith(want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(re.findall(rf"{k}:", want)) for k in PATTERNS]
    out = pii.personal_data(odd.withColumn("__text", F.lit(1))).collect()
    assert len(out) == 10 and all(r.base_sha256 == hashlib.sha256(plain_spans(r.text or "").encode()).hexdigest() for r in out)
    assert pii.personal_data(empty).collect() == []


def test_added_spans_among_other_numbers(spark):
    secret = "password=" + "a1b2" * 75
    texts = ["call phone (873) 555-4781 now. call phone (212) 555-1234 now.", "in room 7 please call phone (212) 555-1234 now.", secret + " end", "order 555-123-4567 shipped", "mail a@b.cc, call (212) 555-1234, ip 10.0.0.1 and password=x9y8z7w6v5"]
    got = [r.spans for r in pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got[:4] == ["phone_local:11:25,phone_local:42:56", "phone_local:28:42", f"secret:0:{len(secret)}", ""]
    assert got[4] == "email:5:11,ip:37:45,phone_local:18:32,secret:50:69"
    out = [r.text for r in pii.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert out[0] == "call phone <phone_local> now. call phone <phone_local> now." and out[2] == "<secret> end" and out[4] == "mail <email>, call <phone_local>, ip <ip> and <secret>"


def test_overlaps_against_a_plain_walk(spark):
    rng = random.Random(21)
    rows = []
    for i in range(150):
        base = [(a, a + rng.randint(1, 6), "b") for a in rng.sample(range(60), rng.randint(0, 4))]
        rows.append((i, sorted(base), [(a, float(rng.randint(0, 5)), a + rng.randint(1, 12), k) for k in "pqr" for a in sorted(rng.sample(range(60), rng.randint(0, 5)))]))
    rows.append((999, [], [(3 * a, float(a % 7), 3 * a + 5, "p") for a in range(1500)]))
    df = spark.createDataFrame(rows, f"i int, b array<struct<start:int,end:int,kind:string>>, c array<{pii.SCORED}>")
    got = {r.i: [tuple(s) for s in r.out] for r in df.select("i", F.when(F.size("c") > 0, pii.added(F.col("b"), F.col("c"))).otherwise(F.array()).alias("out")).collect()}
    for i, base, chosen in rows:
        free = sorted(s for s in chosen if not any(s[0] < e and a < s[2] for a, e, _ in base))
        held, out = None, []
        for s in free:
            if held is None or s[0] >= held[2]:
                out += [held] if held else []
                held = s
            elif s[1] > held[1]:
                held = s
        assert got[i] == out + ([held] if held else []), i


def test_long_texts_take_seconds(spark):
    import time

    texts = ["call phone (873) 555-4781 now. " * 8000, "a" * 400_000 + " @ b", "1" * 400_000]
    begin = time.time()
    got = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert got[0].spans.count("phone_local") == 8000 and time.time() - begin < 90


def test_trees_as_sql_and_added_spans(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    trees = boosting.boost(x, (x[:, 0] * x[:, 1] > 0).astype(float), trees=15, depth=3)
    assert np.mean((trees.logits(x) > 0) == (x[:, 0] * x[:, 1] > 0)) > 0.9
    got = spark.createDataFrame(x.tolist(), "a double, b double, c double").select("a", trees.column([F.col(c) for c in "abc"]).alias("z")).collect()
    want = dict(zip(x[:, 0].tolist(), trees.logits(x).tolist(), strict=True))
    assert all(abs(want[r.a] - r.z) < 1e-9 for r in got)
    texts = ["call phone (873) 555-4781 now", "order 873 555 4781 shipped", "password=abc123def456ab here", "my ssn 123-45-6789", "plain text"]
    out = pii.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [bool(r.spans) for r in out] == [True, False, True, True, False]
    assert "<secret>" in out[2].text and "abc123" not in out[2].text and out[4].text == texts[4]
    made = pii.generated(np.random.default_rng(77), 400)
    made += [("token=" + "a1B2c3D4" * 60 + " end", "long")]
    whole = pii.with_spans(spark.createDataFrame([(0, made[-1][0])], "doc_id long, text string"), "text").first()
    assert [(s.start, s.end) for s in whole["__proposed"] if s.kind == "secret"] == [(0, 486)]
    made.pop()
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(made)], "doc_id long, text string")
    hit = {r.doc_id: bool(r.spans) for r in pii.personal_data(rows).collect()}
    assert np.mean([hit[i] == bool(d) for i, (_, d) in enumerate(made)]) > 0.9


# pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    passage = " ".join(words(rng, 70, 10**6))
    item = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(25))
    docs = []
    for i in range(240):
        w = " ".join(words(rng, 60, 10**6))
        if i % 4 == 0:
            w += " scumba" if i % 8 else " scumki"
        docs.append((i, w + ("\n" + passage if i % 10 == 1 else ""), "en", f"s{i % 5}", 0))
    docs += [(1000, docs[2][1], "en", "s1", 0), (1001, docs[3][1] + " more", "en", "s1", 0), (1002, "x " + item + " y", "en", "s2", 0), (1003, None, None, None, 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d[0], 1, int("scum" in d[1])) for d in docs[:240]], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    at, kept = common.table(spark, str(tmp_path), "documents"), {}
    columns = at.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id: r for r in at.collect()}
        assert name == "mixing" or at.columns == columns
    clean = {d[0] for d in docs if d[1] and "scum" not in d[1]}
    assert len(clean - kept["toxicity"].keys()) <= 0.05 * len(clean) and sum(i in kept["toxicity"] for i in range(0, 240, 4)) <= 6
    assert sum(passage in (r.text or "") for r in kept["line_dedup"].values()) == 1
    rows = [(i, r.text) for i, r in kept["line_dedup"].items()]
    assert set(kept["near_dedup"]) == set(plain_near_groups(rows).values())
    assert set(kept["near_dedup"]) - set(kept["decontamination"]) == {1002} & kept["near_dedup"].keys()
    assert set(kept["mixing"]) == set(kept["decontamination"])
    assert json.dumps([n for n, _ in corpus_pipeline.STAGES])


def test_pipeline_on_empty_and_odd_tables(spark, tmp_path):
    import corpus_pipeline

    docs = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    odd = [(i, t, None, s, None, None) for i, t, s, _ in odd_rows()]
    for name, rows in (("none", []), ("odd", odd)):
        spark.createDataFrame(rows, docs).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    got = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    # Texts without words are copies of one another, and so are the two long ones, one of which has lost its lines.
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == [1, 4, 5, 5, 7] and sum(r.doc_id is None for r in got) == 2
    assert {r.size for r in got if r.doc_id == 7} == {60_000}
