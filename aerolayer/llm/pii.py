"""Personal data: candidate spans, boosted trees and calibrated thresholds, in DataFrame operations alone.

Base spans follow fixed patterns and checks.  Besides, high-recall generators propose overlapping spans (local
phone numbers, written-out mail addresses, social security numbers, bank accounts, secrets); features of their
format and of the 40 characters before them go to boosted trees, which become one SQL expression; spans whose
score reaches the threshold calibrated for their kind and that overlap neither a base span nor a better one
are added (a walk from left to right decides).  The trees are trained on the driver on generated sentences that pass the same expressions.
Everything of one text stays in arrays of its row: nothing is exploded or shuffled.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosting import Trees, boost
from .common import table

#: Base kinds and their patterns.  Repetitions that nothing follows are possessive, which matches the same and needs no
#: stack.  A match starts where a run of its first characters does or where the last match ended: from within a run
#: nothing more can match, and trying would take the square of the run's length.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of further kinds.
PROPOSED = {
    "email_text": r"(?i)[a-z0-9._%+-]{2,64} ?(?:\(at\)|\[at\]| at ) ?[a-z0-9-]{2,63}(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[a-z]{2,12}){1,3}",
    "phone_local": r"(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}",
    "ssn": r"[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "secret": r"(?i)(?:password|passwd|passphrase|secret|token|api[_-]?key)\x20?[=:]\x20?[^\x20\x09-\x0D]{4,}+",
}
KINDS = [*BASE, *PROPOSED]
#: Words before a span that speak for a kind, or against all.
CUES = {
    "mail": r"mail|contact|write to|kontakt|correo|courriel",
    "phone": r"phone|\btel|call|fax|mobile|cell|dial|telefon|tél",
    "ssn": r"\bssn|social|security n",
    "bank": r"iban|account|bank|konto|cuenta|compte",
    "other": r"order|invoice|page|ref|version|serial|isbn|model|score|results?|between|pages",
}
BEFORE, NEAR, STEP, CHUNK = 40, 14, 256, 1024
#: Sentences generated for training, and the precision that calibrates thresholds.
SENTENCES, PRECISION, SEED = 4000, 0.97, 13

SPAN = "struct<kind:string,start:int,end:int,found:string>"
SCORED = "struct<start:int,score:double,end:int,kind:string>"


def bind(value: Column, body) -> Column:
    """body(value), with value computed once whatever its uses."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan(xs: Column, zero: Column, out: str, step) -> Column:
    """step(carry, x) = struct(carry, out) along xs: the array of all ``out`` (a type), in blocks, so that no long array is copied for each element."""
    none = F.array().cast(f"array<{out}>")

    def within(carry: Column, part: Column) -> Column:
        begin = F.struct(carry.alias("carry"), none.alias("out"))
        return F.aggregate(part, begin, lambda a, x: bind(step(a["carry"], x), lambda r: F.struct(r["carry"].alias("carry"), F.concat(a["out"], F.array(r["out"])).alias("out"))))

    def over(cell: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(cell) - 1) / STEP).cast("int"))
        begin = F.struct(zero.alias("carry"), F.array().cast(f"array<array<{out}>>").alias("out"))
        add = lambda a, k: bind(within(a["carry"], F.slice(cell, k * STEP + 1, F.lit(STEP))), lambda r: F.struct(r["carry"].alias("carry"), F.concat(a["out"], F.array(r["out"])).alias("out")))
        return F.flatten(F.aggregate(blocks, begin, add, lambda a: a["out"]))

    return bind(xs, lambda cell: F.when(F.size(cell) > 0, over(cell)).otherwise(none))


def spans(text: Column, kind: str, pattern: str) -> Column:
    """array of (kind, start, end, found): leftmost non-overlapping matches, in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def place(cell: Column) -> Column:
        #: Each match with what precedes it.
        gaps = F.transform(cell["found"], lambda m, i: F.struct(m.alias("m"), F.length(F.element_at(cell["pieces"], i + 1)).alias("gap")))
        step = lambda at, x: F.struct(
            (at + x["gap"] + F.length(x["m"])).alias("carry"),
            F.struct(F.lit(kind).alias("kind"), (at + x["gap"]).alias("start"), (at + x["gap"] + F.length(x["m"])).alias("end"), x["m"].alias("found")).alias("out"),
        )
        return scan(gaps, F.lit(0), SPAN, step)

    return bind(F.struct(found.alias("found"), pieces.alias("pieces")), place)


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum of a digit string holds."""
    xs = F.split(F.reverse(digits), "")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = F.transform(F.filter(xs, lambda c: c != ""), lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def holds(kind: str, found: Column) -> Column:
    """The check of a base kind."""
    n = F.length(digits_of(found))
    if kind == "ip":
        small = lambda p: (F.length(p) <= 3) & (F.coalesce(F.nullif(F.substring(p, 1, 3), F.lit("")), F.lit("0")).cast("int") <= 255)
        return F.forall(F.split(found, r"\."), lambda p: small(F.regexp_replace(p, "^0+", "")))
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), luhn(digits_of(found))).otherwise(False)
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def with_spans(rows: DataFrame, text: str) -> DataFrame:
    """Adds __base and __proposed, arrays of spans of the not-null column ``text``."""
    t = F.col(text)
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,found:string>>")
    digit, at = t.rlike("[0-9]"), t.contains("@")
    needs = {"email": at, "ip": digit, "card": digit, "phone": t.contains("+") & digit}
    needs |= {"email_text": t.rlike(r"(?i)[ (\[]at[ )\]].{0,80}(?:\.|dot)"), "phone_local": digit, "ssn": digit, "iban": digit, "secret": t.rlike(r"(?i)pass(?:word|wd|phrase)|secret|token|api[_-]?key")}
    for kind, pattern in [*BASE.items(), *PROPOSED.items()]:
        rows = rows.withColumn(f"__{kind}", F.when(needs[kind], spans(t, kind, pattern)).otherwise(empty))
    checked = lambda k: F.filter(f"__{k}", lambda s: holds(k, s["found"]))
    base = F.concat(*[checked(k) for k in BASE])
    return rows.withColumn("__base", base).withColumn("__proposed", F.concat(*[f"__{k}" for k in PROPOSED])).drop(*[f"__{k}" for k in KINDS])


def chunks_of(text: Column) -> Column:
    """The text in pieces of CHUNK code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def piece(chunks: Column, start: Column, size: Column | int) -> Column:
    """Up to ``size`` (at most CHUNK) code points from ``start``, without a walk from the text's beginning."""
    k = F.floor(start / CHUNK).cast("int")
    two = F.concat(F.coalesce(F.get(chunks, k), F.lit("")), F.coalesce(F.get(chunks, k + 1), F.lit("")))
    return F.substring(two, start - k * CHUNK + 1, F.lit(size) if isinstance(size, int) else size)


def features(s: Column, chunks: Column) -> Column:
    """Format and context of span s, as an array of numbers."""
    context = F.struct(
        F.lower(piece(chunks, F.greatest(s["start"] - BEFORE, F.lit(0)), F.least(F.lit(BEFORE), s["start"]))).alias("before"),
        piece(chunks, s["end"], 1).alias("following"),
        digits_of(s["found"]).alias("digits"),
        s["found"].alias("found"),
        s["kind"].alias("kind"),
    )
    flag = lambda c: F.coalesce(c.cast("int"), F.lit(0))

    def numbers(c: Column) -> Column:
        near, last = F.right(c["before"], F.lit(NEAR)), F.right(c["before"], F.lit(1))
        out = [flag(c["kind"] == k) for k in PROPOSED]
        out += [flag(c["before"].rlike(x)) for x in CUES.values()]
        out += [flag(near.rlike(x)) for x in CUES.values()]
        out += [flag(last.rlike(r"[\w.+-]")), flag(c["following"].rlike(r"[\w@+]")), flag(near.rlike(r"[0-9]")), flag(last.rlike("[:(]"))]
        out += [F.length(c["found"]), F.length(c["digits"]), F.length(F.regexp_replace(c["found"], "[^A-Za-z]", "")), F.length(F.regexp_replace(c["found"], r"[^\x20.-]", ""))]
        out += [F.size(F.array_distinct(F.split(c["digits"], ""))), flag(c["found"].rlike(r"[.]")), flag(c["found"].rlike(r"[(]")), flag(c["found"].rlike(r"(?i)\(at\)|\[at\]|dot")), flag(c["found"].rlike("^(?:000|666|9|0)"))]
        return F.array(*[x.cast("double") for x in out])

    return bind(context, numbers)


#: Numbers in features: one for each proposed kind, two for each cue, and 13 of format.
WIDTH = len(PROPOSED) + 2 * len(CUES) + 13


def generated(rng: np.random.Generator, n: int) -> list[tuple[str, list[str]]]:
    """Texts of one to four clauses and the personal data in them; look-alikes and plain numbers stand between."""
    syllables = "an er the on in le de que la ment ción ung keit tion ing".split()
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    digit = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    sep = lambda: str(rng.choice(["-", " ", "."]))

    def clause() -> tuple[str, str | None]:
        kind, true = int(rng.integers(6)), rng.random() < 0.5
        if kind == 0:
            at, dot = rng.choice(["(at)", "[at]", " (at) ", " [at] "] if true else [" at "]), rng.choice(["(dot)", " dot ", "."] if true else ["."])
            datum = word() + at + word() + dot + rng.choice(["com", "org", "de", "net"] if true else ["The", "En", "on", "la"])
            cue = rng.choice(["mail: ", "contact ", "write to ", ""] if true else ["", "was ", "looked "])
        elif kind == 1:
            a = sep()
            datum = f"({digit(3)}) {digit(3)}{a}{digit(4)}" if rng.random() < 0.5 else f"{digit(3)}{a}{digit(3)}{a}{digit(4)}"
            cue = rng.choice(["phone ", "tel. ", "call ", "fax: ", "mobile ", "call phone ", "phone: "] if true else ["order ", "invoice ", "between ", "pages ", "serial ", "version "])
        elif kind == 2:
            a = rng.choice(["-", " "])
            datum = f"{rng.integers(100, 665)}{a}{digit(2)}{a}{digit(4)}"
            cue = rng.choice(["ssn ", "social security number ", "ssn: "] if true else ["score ", "ref ", "model ", "results "])
        elif kind == 3:
            groups = " ".join(digit(4) for _ in range(rng.integers(3, 6)))
            datum = rng.choice(["DE", "FR", "ES", "GB"]) + digit(2) + " " + groups if true else rng.choice(["AB", "XK", "QT"]) + digit(2) + rng.choice(["ERHE", "THTI", "ONAT"]) + digit(4)
            cue = rng.choice(["iban ", "account ", "bank: ", ""] if true else ["model ", "serial ", "", "ref "])
        elif kind == 4:
            datum = rng.choice(["password", "token", "api_key", "secret"]) + ("=" if true else ": ") + ("".join(rng.choice(list("abcdef0123456789"), rng.choice([8, 14, 40, 300]))) if true else word() + word())
            cue = ""
        else:
            datum, cue, true = digit(rng.integers(1, 5)), rng.choice(["room ", "in ", "at ", "", "since ", "on "]), False
        words = [word() for _ in range(rng.integers(0, 8))]
        tail = [word() for _ in range(rng.integers(1, 3))]
        return f"{' '.join(words)} {cue}{datum} {' '.join(tail)}".strip(), str(datum) if true else None

    out = []
    for _ in range(n):
        made = [clause() for _ in range(rng.integers(1, 5))]
        text = made[0][0]
        for c, _ in made[1:]:
            text += rng.choice([". ", ", ", " ", "; ", "\n"]) + c
        out.append((text + ".", [d for _, d in made if d]))
    return out


def select_features(rows: DataFrame, text: str) -> DataFrame:
    """Adds the features x to the spans of __proposed."""
    add = lambda cell: F.transform(cell["s"], lambda s: F.struct(*[s[k].alias(k) for k in ("kind", "start", "end", "found")], features(s, cell["chunks"]).alias("x")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,found:string,x:array<double>>>")
    return rows.withColumn("__proposed", bind(F.col("__proposed"), lambda p: F.when(F.size(p) > 0, bind(F.struct(p.alias("s"), chunks_of(F.col(text)).alias("chunks")), add)).otherwise(none)))


@cache
def trained(spark: SparkSession) -> tuple[Trees, dict[str, float]]:
    """The trees, and the threshold of each kind: the least at which PRECISION holds on half of the sentences."""
    made = generated(np.random.default_rng(SEED), SENTENCES)
    rows = spark.createDataFrame([(i, t, d) for i, (t, d) in enumerate(made)], "i int, t string, d array<string>").coalesce(1)
    got = select_features(with_spans(rows, "t"), "t").select("i", "t", "d", F.explode("__proposed").alias("s")).select("i", "s.kind", "s.found", "d", "s.x").orderBy("i", "s.start").collect()
    x = np.array([r.x for r in got])
    y = np.array([float(any((r.found in d or d in r.found) and len(r.found) >= 0.8 * len(d) for d in r.d)) for r in got])
    fit = np.array([r.i % 2 == 0 for r in got])
    trees = boost(x[fit], y[fit], trees=20, depth=3, rate=0.4)
    p, kinds, cut = trees.logits(x[~fit]), np.array([r.kind for r in got])[~fit], {}
    for k in PROPOSED:
        s, t = p[kinds == k], y[~fit][kinds == k]
        good = [c for c in np.unique(s) if t[s >= c].mean() >= PRECISION]
        cut[k] = float(min(good)) if good else float("inf")
    return trees, cut


def added(base: Column, chosen: Column) -> Column:
    """The spans of ``chosen`` (SCORED) that overlap no base span, and of those that overlap in turn the better one.

    A walk from left to right holds the best span of those that overlap the one held before; ties go to the
    earlier span.  Base spans stay whatever overlaps them.
    """
    first, last = F.lit(2**31 - 1), F.lit(-1)
    fixed = F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(float("inf")).alias("score"), b["end"].alias("end"), b["kind"].alias("kind")))
    is_base = lambda s: s["score"] == float("inf")
    #: What starts before a span and reaches into it, then what starts within it.
    mark = lambda s, hit: F.when(is_base(s) | ~hit, s)
    forth = lambda end, s: F.struct(F.when(is_base(s), F.greatest(end, s["end"])).otherwise(end).alias("carry"), mark(s, s["start"] < end).alias("out"))
    back = lambda start, s: F.struct(F.when(is_base(s), s["start"]).otherwise(start).alias("carry"), mark(s, s["end"] > start).alias("out"))
    # Sorted by start; from the right, a base span at the same start has been seen before the others.
    some = lambda xs: F.filter(xs, lambda s: s.isNotNull())
    free = some(scan(F.array_sort(F.concat(fixed, chosen)), last, SCORED, forth))
    free = F.filter(some(scan(F.reverse(free), first, SCORED, back)), lambda s: ~is_base(s))
    none = F.lit(None).cast(SCORED)

    def walk(held: Column, s: Column) -> Column:
        apart = held.isNull() | (s["start"] >= held["end"])
        return F.struct(F.when(apart | (s["score"] > held["score"]), s).otherwise(held).alias("carry"), F.when(apart, held).alias("out"))

    #: A last span beyond all others lets the one held go.
    stop = F.array(F.struct(first.alias("start"), F.lit(0.0).alias("score"), first.alias("end"), F.lit("").alias("kind")))
    return some(scan(F.concat(F.array_sort(free), stop), none, SCORED, walk))


def personal_data(docs: DataFrame) -> DataFrame:
    """docs (with doc_id and text) plus counts and digests of the personal data in each whole text.

    n_email, n_ip, n_card, n_phone count base spans; base_sha256 is the SHA-256 of kind:start:end of those by
    kind and start, comma-joined; spans lists them and the added ones alike.  Null and empty texts have none.
    Every row gives a row; input columns with the names of the results are replaced.  Texts of any length are
    taken whole, in time that grows with their length.
    """
    trees, cut = trained(docs.sparkSession)
    results = [*(f"n_{k}" for k in BASE), "base_sha256", "spans"]
    rows = docs.drop(*results).withColumn("__text", F.coalesce("text", F.lit("")))
    rows = select_features(with_spans(rows, "__text"), "__text")
    score = lambda s: trees.column([s["x"][i] for i in range(WIDTH)])
    scored = F.transform("__proposed", lambda s: F.struct(s["start"].alias("start"), score(s).alias("score"), s["end"].alias("end"), s["kind"].alias("kind")))
    enough = lambda s: F.coalesce(*[F.when(s["kind"] == k, s["score"] >= F.lit(c)) for k, c in cut.items()])
    chosen = F.filter(scored, enough)
    none = F.array().cast(f"array<{SCORED}>")
    rows = rows.withColumn("__added", bind(chosen, lambda c: F.when(F.size(c) > 0, bind(F.col("__base"), lambda b: added(b, c))).otherwise(none)))
    named = lambda c: F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    count = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k))
    return rows.select(
        *[c for c in docs.columns if c not in results],
        *[count(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(named("__base"), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(named("__base"), named(F.array_sort("__added"))), ",").alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of personal_data replaced by its kind in angle brackets; adds ``spans``.

    Of spans that overlap the first is named and all are taken out.
    """
    rows = personal_data(docs)
    parts = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    whole = F.struct(F.length("text").alias("start"), F.length("text").alias("end"), F.lit("").alias("kind"))
    order = F.concat(F.array_sort(F.transform(parts, lambda p: F.struct(p[1].cast("int").alias("start"), p[2].cast("int").alias("end"), p[0].alias("kind")))), F.array(whole))

    def text_between(chunks: Column, a: Column, b: Column) -> Column:
        k = F.floor(a / CHUNK).cast("int")
        held = F.array_join(F.slice(chunks, k + 1, F.floor(b / CHUNK).cast("int") - k + 1), "")
        return F.substring(held, a - k * CHUNK + 1, b - a)

    def cut(chunks: Column) -> Column:
        step = lambda at, s: F.struct(
            F.greatest(at, s["end"]).alias("carry"),
            F.when(s["start"] < at, "").otherwise(F.concat(text_between(chunks, at, s["start"]), F.when(s["kind"] == "", "").otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">"))))).alias("out"),
        )
        return F.array_join(scan(order, F.lit(0), "string", step), "")

    return rows.withColumn("text", F.when(F.col("text").isNotNull(), bind(chunks_of(F.col("text")), cut))).select(*docs.columns, *(["spans"] if "spans" not in docs.columns else []))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
