"""Line deduplication by prefix doubling over line-id sequences.

Every line that occurs twice or more starts a suffix.  Doubling names its prefixes of 1, 2, 4, ... lines:
two prefixes of 2**(k+1) lines are equal iff the names of their halves are, and suffixes whose prefix is
unique leave.  Walking the levels back down places each suffix in the longest-common-prefix interval it
shares with an earlier one: an interval is the set of suffixes with one common prefix, its first member
stands for it in the next test, and all others move into it.  What remains is, for each suffix, the length
of the longest run of lines that has occurred before (the longest previous factor), exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from .common import Scratch, table

#: Later copies of runs with more words than this go.
WORDS = 50


def line_table(docs: DataFrame) -> DataFrame:
    """(d, h, p, n1, n2): the 128-bit name of line p of the text with hash h of document d.

    Names are the halves of the line's MD5.  Lines are cut by Spark itself, row by row: whole batches of texts for
    Python workers would be held twice.
    """
    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("d"), F.col("text").cast("string").alias("text"))
    lines = rows.select("d", F.xxhash64("text").alias("h"), F.posexplode(F.split("text", "\n")).alias("p", "line"))
    half = lambda at: F.conv(F.substring("m", at, 16), 16, -10).cast("long")
    return lines.select("d", "h", "p", F.md5("line").alias("m")).select("d", "h", "p", half(1).alias("n1"), half(17).alias("n2"))


def name(a: str, b: str, *also) -> Column:
    return F.xxhash64(F.col(a), F.col(b), *also)


def previous_runs(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(d, h, p, len): the longest run of len >= 1 lines from line p that an earlier line also starts.

    Earlier is by doc_id, then text hash, then line.
    """

    def repeated(rows: DataFrame, label: str) -> DataFrame:
        groups = rows.groupBy("n1", "n2").agg(F.count("*").alias("n")).where("n > 1").select("n1", "n2")
        groups = scratch.write(groups, f"{label}-names")
        out = scratch.write(rows.join(groups, ["n1", "n2"], "left_semi"), label)
        scratch.drop(groups)
        return out

    lines = scratch.write(line_table(docs), "lines")
    #: Repeated rows of the input count as one document.
    levels = [scratch.write(repeated(lines, "all").dropDuplicates(["d", "h", "p"]), "level0")]
    scratch.drop(lines)
    while True:
        k, a = len(levels) - 1, levels[-1]
        b = a.select("d", "h", (F.col("p") - 2**k).alias("p"), F.col("n1").alias("m1"), F.col("n2").alias("m2"))
        pairs = a.join(b, ["d", "h", "p"]).select("d", "h", "p", name("n1", "m1").alias("n1"), name("m2", "n2", F.lit(k)).alias("n2"))
        pairs = scratch.write(pairs, f"pairs{k}")
        up = repeated(pairs, f"level{k + 1}")
        scratch.drop(pairs)
        if up.isEmpty():
            break
        levels.append(up)
    state = levels[0].select(F.lit(0).cast("long").alias("g1"), F.lit(0).cast("long").alias("g2"), F.lit(0).alias("len"), "d", "h", "p", F.lit(True).alias("own"))
    for k in reversed(range(len(levels))):
        block = levels[k].select("d", "h", F.col("p").alias("at"), "n1", "n2").withColumn("there", F.lit(True))
        tests = state.withColumn("at", F.col("p") + F.col("len")).join(block, ["d", "h", "at"], "left")
        #: Rows without such a block get keys of their own, spread over all tasks.
        tests = tests.select(
            *state.columns,
            F.when(F.col("there"), name("g1", "n1")).otherwise(F.xxhash64("d", "h", "p", F.lit("none"))).alias("c1"),
            F.when(F.col("there"), name("n2", "g2")).otherwise(F.xxhash64("g2", "p")).alias("c2"),
            F.coalesce("there", F.lit(False)).alias("there"),
        )
        tests = scratch.write(tests, f"tests{k}")
        firsts = tests.where("there").groupBy("c1", "c2").agg(F.min(F.struct("d", "h", "p")).alias("first"), F.count("*").alias("n"))
        firsts = scratch.write(firsts.where("n > 1").select("c1", "c2", "first"), f"firsts{k}")
        same = F.struct("g1", "g2", "len", "own")
        deeper = lambda own: F.struct(F.col("c1").alias("g1"), F.col("c2").alias("g2"), (F.col("len") + 2**k).alias("len"), own.alias("own"))
        roles = (
            F.when(F.col("first").isNull(), F.array(same))
            .when(F.col("first") == F.struct("d", "h", "p"), F.array(same, deeper(F.lit(False))))
            .otherwise(F.array(deeper(F.col("own"))))
        )
        old, state = state, tests.join(firsts, ["c1", "c2"], "left").select("d", "h", "p", F.explode(roles).alias("r"))
        state = scratch.write(state.select("r.g1", "r.g2", "r.len", "d", "h", "p", "r.own"), f"state{k}")
        scratch.drop(old, tests, firsts, levels[k])
    return state.where("own and len > 0").select("d", "h", "p", "len")


def dropped_lines(text: bytes, starts, lengths, words: int) -> np.ndarray:
    """True for each line that a run with over ``words`` words covers."""
    n = np.cumsum([0, *(len(x.split()) for x in text.split(b"\n"))])
    s, e = np.asarray(starts), np.asarray(starts) + np.asarray(lengths)
    far = n[e] - n[s] > words
    marks = np.zeros(len(n), np.int64)
    np.add.at(marks, s[far], 1)
    np.add.at(marks, e[far], -1)
    return np.cumsum(marks)[:-1] > 0


def deduplicate_lines(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """documents with ``text`` rid of line runs of over ``words`` words that occurred before.

    Adds n_lines (long; 0 for null texts) and removed (string: the 0-based lines removed as start-end with
    end exclusive, comma-joined; empty if none).  Lines end at \\n; a run is a sequence of consecutive lines
    of one document, of any number of lines; the first copy is the one of the smallest doc_id, and within it
    the first.  Copies may overlap.  A document whose lines all go keeps an empty text.  Rows with a null
    doc_id or text stay as they are; repeated rows count as one document and are edited alike.  Input columns
    named n_lines or removed are replaced; other columns stay.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    runs = previous_runs(docs, scratch)
    runs = runs.groupBy(F.col("d").alias("__d"), F.col("h").alias("__h")).agg(F.collect_list(F.struct("p", "len")).alias("__r"))
    runs = scratch.write(runs.select("__d", "__h", F.col("__r.p").alias("__s"), F.col("__r.len").alias("__n")), "runs")

    @pandas_udf("struct<text:string,removed:string>")
    def edit(text, s, n):
        import pandas as pd

        out = {"text": [], "removed": []}
        for t, a, b in zip(text, s, n, strict=True):
            if t is None or a is None:
                out["text"].append(t)
                out["removed"].append("")
                continue
            raw = t.encode("utf-8", "surrogatepass")
            gone = dropped_lines(raw, a, b, words)
            out["text"].append(b"\n".join(x for x, g in zip(raw.split(b"\n"), gone, strict=True) if not g).decode("utf-8", "surrogatepass"))
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
            out["removed"].append(",".join(f"{x}-{y}" for x, y in edge.reshape(-1, 2)))
        return pd.DataFrame(out)

    keep = [c for c in docs.columns if c not in ("n_lines", "removed")]
    out = docs.select(*keep, F.col("doc_id").cast("long").alias("__d"), F.xxhash64("text").alias("__h")).join(runs, ["__d", "__h"], "left")
    out = out.withColumn("__e", edit(F.when(F.col("__s").isNotNull(), F.col("text")), "__s", "__n"))
    n_lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
    return out.select(
        *[F.when(F.col("__s").isNotNull(), F.col("__e.text")).otherwise(F.col("text")).alias("text") if c == "text" else c for c in keep],
        n_lines.alias("n_lines"),
        F.coalesce("__e.removed", F.lit("")).alias("removed"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edited texts of documents."""
    return deduplicate_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "removed", "text")
