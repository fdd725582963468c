"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source, exact length and hash bucket.  A source's target is met by whole passes
over its documents and one partial pass; the partial pass first takes its share of every length, then
bounded-knapsack dynamic programming over the remaining documents fits what is left of the budget, in units
of several words first where that is long.  Which documents of a length are taken follows a seeded hash:
whole buckets, and ranks only within the one bucket where a quota ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch, release, table

#: Weights of sources in code point order, repeating; passes a document may have; seed.
WEIGHTS, MOST, SEED = (5, 2, 1), 3, 17
#: Least hash buckets of a length, and documents of a length in each, about, where it has more.
BUCKETS, BUCKET_ROWS = 64, 1024
#: Sums that one run of the dynamic programming tells apart; longer budgets take larger units first.
SUMS = 1 << 20


def water_fill(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Targets that share all of ``sizes`` by weight, none above ``most`` times its size."""
    total, targets = float(sum(sizes)), [0.0] * len(sizes)
    free, left = set(range(len(sizes))), float(sum(sizes))
    while free:
        share = left / sum(weights[i] for i in free)
        over = {i for i in free if weights[i] * share > most * sizes[i]}
        if not over:
            for i in free:
                targets[i] = weights[i] * share
            break
        for i in over:
            targets[i] = float(most * sizes[i])
        free -= over
        left = total - sum(targets[i] for i in range(len(sizes)) if i not in free)
    return targets


def subset_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take, so that their sum comes as near below ``budget`` as it can.

    Bounded knapsack over bitsets: counts are split into powers of two, and each reachable sum remembers
    the part that reached it first.
    """
    parts = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        c, k = min(int(counts[i]), budget // n) if n else 0, 1
        while c > 0:
            parts.append((i, min(k, c)))
            c, k = c - k, 2 * k
    reached, first, mask = 1, np.full(budget + 1, -1, np.int32), (1 << (budget + 1)) - 1
    for p, (i, k) in enumerate(parts):
        new = (reached << (int(lengths[i]) * k)) & mask & ~reached
        if new:
            raw = np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8)
            at = np.flatnonzero(raw)
            bits = np.unpackbits(raw[at], bitorder="little").reshape(-1, 8)
            first[(8 * at[:, None] + np.arange(8))[bits.astype(bool)]] = p
            reached |= new
        if reached >> budget:
            break
    take, at = np.zeros(len(lengths), np.int64), reached.bit_length() - 1
    while at > 0:
        i, k = parts[first[at]]
        take[i] += k
        at -= int(lengths[i]) * k
    return take


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take for ``budget`` words: subset sums in units of at most budget / SUMS words, then finer.

    Lengths are rounded up to units, so that no round takes too much; the last round's unit is a word.
    """
    take, left = np.zeros(len(lengths), np.int64), budget
    while left > 0:
        unit = -(-left // SUMS)
        open_ = (counts > take) & (lengths > 0) & (lengths <= left)
        if not open_.any():
            break
        more = subset_sum(-(-lengths[open_] // unit), (counts - take)[open_], left // unit)
        take[open_] += more
        left -= int((more * lengths[open_]).sum())
        if unit == 1:
            break
        if not more.any():
            # Rounded up, nothing fits: the longest that does is at least half of a unit short of left.
            i = np.flatnonzero(open_)[np.argmax(lengths[open_])]
            take[i] += 1
            left -= int(lengths[i])
    return take


def partial_pass(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length the partial pass takes, for ``budget`` words.

    Every length gives its share, rounded down, and ``fill`` spends the rest; where that leaves words, smaller
    shares and at last none are tried, which leaves more documents to choose from, and the nearest is taken.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if total <= budget:
        return counts.copy()
    best, rest = np.zeros(len(lengths), np.int64), budget
    for part in (1.0, 0.5, 0.0):
        take = np.floor(counts * (lengths > 0) * (part * budget / total)).astype(np.int64)
        take += fill(lengths, counts - take, budget - int((take * lengths).sum()))
        left = budget - int((take * lengths).sum())
        if left < rest:
            best, rest = take, left
        if left == 0:
            break
    return best


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): how many words of each document the mix takes.

    size counts words (null text: 0).  Sources in code point order, null last, have ``weights`` in turn and
    share all words by them; targets stop at ``most`` times their source's size.  Each document is taken
    a whole number of times, at most ``most``; reruns agree.  Documents without words take none.  Rows that
    repeat a doc_id are told apart by nothing but chance ties, in which either may be taken; a null doc_id
    is a value like others.  Other columns are ignored, an empty table gives an empty result.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "mix")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"))
    rows = rows.withColumn("order", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(seed)))
    rows = scratch.write(rows, "rows")
    # The most frequent length decides on the number of buckets; rarer ones have at most as many as documents.
    frequent = rows.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = max(BUCKETS, 1 << (frequent // BUCKET_ROWS).bit_length())
    rows = rows.withColumn("bucket", F.pmod("order", F.lit(buckets)).cast("int"))
    counts = scratch.write(rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "counts")
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    #: One row for each source: a source list is a table of contents, not corpus data.
    listed = sorted(sizes.collect(), key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")))
    targets = water_fill([r[1] for r in listed], [weights[i % len(weights)] for i in range(len(listed))], most)
    goals = spark.createDataFrame([(r[0], r[1], t) for r, t in zip(listed, targets, strict=True)], "source string, source_size long, target double")

    def plan(batch: pa.Table) -> pa.Table:
        source, lengths, n = batch.column("source")[0].as_py(), batch.column("size").to_numpy(), batch.column("n").to_numpy()
        order = np.argsort(lengths)
        lengths, n = lengths[order], n[order]
        size, target = batch.column("source_size")[0].as_py(), batch.column("target")[0].as_py()
        passes = min(most, int(target // size)) if size else 0
        budget = round(target - passes * size) if passes < most else 0
        take = partial_pass(lengths, n, budget)
        release()
        return pa.table({"source": pa.array([source] * len(n), pa.string()), "size": lengths, "take": take, "passes": np.full(len(n), passes), "source_size": np.full(len(n), size), "target": np.full(len(n), target)})

    lengths = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    told = lengths.join(goals, lengths["source"].eqNullSafe(goals["source"])).select(lengths["source"], "size", "n", "source_size", "target")
    takes = told.groupBy("source").applyInArrow(plan, "source string, size long, take long, passes long, source_size long, target double")
    takes = scratch.write(takes.withColumnsRenamed({"source": "s", "size": "l"}), "takes")
    # A length's quota fills its buckets in order: one row for each bucket of BUCKET_ROWS documents.
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quotas = counts.withColumn("before", before).join(takes, counts["source"].eqNullSafe(F.col("s")) & (F.col("size") == F.col("l")))
    quota = F.greatest(F.lit(0), F.least(F.col("n"), F.col("take") - F.col("before"))).cast("long")
    quotas = scratch.write(quotas.select("source", "size", "bucket", "n", quota.alias("quota"), "passes", "source_size", "target"), "quotas")
    plans = quotas.select(F.col("source").alias("s"), F.col("size").alias("l"), F.col("bucket").alias("k"), "quota", "n", "passes", "source_size", "target")
    told = rows.join(plans, rows["source"].eqNullSafe(F.col("s")) & (F.col("size") == F.col("l")) & (F.col("bucket") == F.col("k")))
    told = told.select("doc_id", "source", "size", "order", "bucket", "quota", "n", "passes", "source_size", "target")
    ranked = told.where("quota > 0 and quota < n")
    w = Window.partitionBy("source", "size", "bucket").orderBy("order", F.col("doc_id").asc_nulls_last())
    ranked = ranked.withColumn("extra", (F.row_number().over(w) <= F.col("quota")).cast("long"))
    whole = told.where("quota = 0 or quota = n").withColumn("extra", (F.col("quota") > 0).cast("long"))
    out = whole.unionByName(ranked).withColumn("taken", F.col("size") * (F.col("passes") + F.col("extra")))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
