"""Secret scan: fixed patterns, plus a randomness test battery over token-like strings, in DataFrame expressions only.

Battery. A candidate is a run of 16 or more characters of ``[A-Za-z0-9+/_-]`` and up to two ``=`` after it, which are in the
span but not tested. Its encoding is inferred from the characters it has (hex, base36 in one case, base62, base64), and three statistics compare it with a random string of that
alphabet, each about standard normal for one: Pearson's chi-squared of the symbol counts (one-sided), the
Wald-Wolfowitz number of runs above and below the middle of the alphabet, and the lag-1 serial correlation of the
symbol values (two-sided). The score is the largest of the three; random strings score low, written language high.

False-discovery control. Runs of letters in ordinary case and runs of digits only are no secrets: they are the decoys, and
they are scored against the alphabets of the targets (digits as hex, words as the others). Per encoding and length class
a target's p-value is the share of decoys of its length or shorter that look as random (short strings test weakly, so
short decoys are the stricter ones), and the Benjamini-Hochberg step-up over the targets of the class fixes the largest
score that is reported at level ``q``. A class without decoys has p-values of 1 and reports nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.llm.quality import let

#: Fixed patterns: kind -> (pattern, group that must be so long, least length). A greedy run is maximal, so a least
#: length inside the pattern of access and hex finds the same matches as filtering them afterwards.
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
#: A run of 16 or more, with the padding that ends it; a '=' before more characters parts a name from its value.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
#: encoding -> its alphabet; the order is that of inference, the first that holds all characters wins.
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
#: Decoys: what they look like, and the encodings whose targets they are compared with.
WORD, NUMBER = "^([A-Z]?[a-z]+|[A-Z]+)$", "^[0-9]+$"
#: Least lengths of the length classes.
LENGTHS = (16, 20, 24, 32, 48, 64)
#: Scores are compared in steps of 1/STEPS.
STEPS = 20
Q = 0.05


def spans_of(text: Column, pattern: str, group: int, least: int, kind: str, order: int) -> Column:
    """array<struct<start, order, kind, end, found>> of the leftmost non-overlapping matches whose ``group`` has at
    least ``least`` characters; positions in code points. Java gives no positions, but the pieces between the matches and
    the matches, laid end to end, do."""
    empty = F.expr("CAST(array() AS array<struct<start:bigint,ord:int,kind:string,end:bigint,found:string>>)")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(f: Column) -> Column:
        groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else f
        lengths = F.transform(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), f.alias("f")), lambda r: (
            F.char_length(r["gap"]) + F.coalesce(F.char_length(r["f"]), F.lit(0))).cast("long"))
        rows = F.arrays_zip(_sums(lengths, F.size(f)).alias("end"), f.alias("f"), groups.alias("g"))
        good = F.filter(rows, lambda r: r["f"].isNotNull() & (F.char_length(r["g"]) >= least))
        return F.transform(good, lambda r: F.struct(
            (r["end"] - F.char_length(r["f"])).alias("start"), F.lit(order).alias("ord"), F.lit(kind).alias("kind"),
            r["end"].alias("end"), r["f"].alias("found")))

    return F.element_at(F.transform(F.array(found), lambda f: F.when(F.size(f) == 0, empty).otherwise(place(f))), 1)


def _sums(lengths: Column, n: Column) -> Column:
    """Running sums of an array of n + 1 longs by doubling: each pass adds what lies 1, 2, 4, ... places before, so that the
    time grows with n log n and not with its square."""
    passes = F.sequence(F.lit(0), F.length(F.bin(n)) - 1)
    return F.aggregate(passes, lengths, lambda a, j: F.transform(
        a, lambda x, i: x + F.coalesce(F.get(a, i - F.call_function("shiftleft", F.lit(1), j)), F.lit(0).cast("long"))))


def _encoding(token: Column) -> Column:
    out = F.when(token.rlike(NUMBER), "hex").when(token.rlike(WORD), F.lit(None).cast("string"))
    for name, letters in ALPHABETS.items():
        out = out.when(F.translate(token, letters, "") == "", name)
    return out


def _length_class(length: Column) -> Column:
    out = F.lit(0)
    for i, n in enumerate(LENGTHS[1:], 1):
        out = F.when(length >= n, i).otherwise(out)
    return out


def _bare(token: Column) -> Column:
    """A candidate without its padding."""
    return F.rtrim(token, F.lit("="))


def limits(tokens: DataFrame, q: float = Q) -> DataFrame:
    """(encoding, len_class, limit): the largest score reported, from the candidates ``tokens`` (token, without padding) of all texts.

    Scores are counted per class first, so that the ranks come from tables of a few thousand rows, however many
    candidates there are.
    """
    t = tokens.select("token", _encoding(F.col("token")).alias("own"), _length_class(F.length("token")).alias("len_class"))
    number, word = F.col("token").rlike(NUMBER), F.col("token").rlike(WORD)
    against = F.when(number, F.array(F.lit("hex"), F.lit("HEX"))).when(
        word, F.array(*[F.lit(e) for e in ALPHABETS if e not in ("hex", "HEX")])).when(F.col("own").isNotNull(), F.array("own"))
    t = t.select("token", "len_class", (number | word).alias("decoy"), F.explode(against).alias("encoding"))
    # a decoy in the other case is compared as if written in the alphabet's case
    t = t.withColumn("token", F.when(F.col("encoding") == "base36", F.lower("token")).when(
        F.col("encoding") == "BASE36", F.upper("token")).otherwise(F.col("token")))
    t = t.groupBy("encoding", "len_class", "decoy", "token").agg(F.count("*").alias("times"))
    t = t.withColumn("score", battery(F.col("token"), _alphabet(F.col("encoding"))))
    seen = t.groupBy("encoding", "len_class", "score").agg(
        F.sum(F.when(F.col("decoy"), F.col("times")).otherwise(0)).alias("decoys"),
        F.sum(F.when(F.col("decoy"), 0).otherwise(F.col("times"))).alias("targets"))
    classes = F.explode(F.sequence(F.col("len_class"), F.lit(len(LENGTHS) - 1)))
    seen = seen.withColumn("own", F.col("len_class")).withColumn("len_class", classes).groupBy("encoding", "len_class", "score").agg(
        F.sum("decoys").alias("decoys"), F.sum(F.when(F.col("own") == F.col("len_class"), F.col("targets")).otherwise(0)).alias("targets"))
    upto = Window.partitionBy("encoding", "len_class").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("encoding", "len_class")
    p = (F.sum("decoys").over(upto) + 1) / (F.sum("decoys").over(whole) + 1)
    return seen.withColumn("p", p).withColumn("found", F.sum("targets").over(upto)).withColumn(
        "all", F.sum("targets").over(whole)).where(
        F.expr(f"targets > 0 AND p * all <= {q} * found")).groupBy("encoding", "len_class").agg(F.max("score").alias("limit"))


def _alphabet(encoding: Column) -> Column:
    out = F.lit("")
    for name, letters in ALPHABETS.items():
        out = F.when(encoding == name, letters).otherwise(out)
    return out


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """(id, spans array<struct<start, kind, end>>) per row, ordered by start, then kind (assign, access, hex, random).

    Null text counts as empty and has no spans; repeated rows and null ids stay; other columns are not read; an empty
    table gives an empty one. Candidates that a fixed pattern overlaps are not reported a second time.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = df.select(F.col(id_col).alias("id"), text.alias("t"))
    base = F.concat(*[spans_of(F.col("t"), p, g, n, kind, i) for i, (kind, (p, g, n)) in enumerate(PATTERNS.items())])
    tokens = d.select(F.explode(F.regexp_extract_all("t", F.lit(CANDIDATE), F.lit(0))).alias("token")).select(_bare(F.col("token")).alias("token"))
    found = limits(tokens, q).collect()  # at most one row an encoding and length class
    d = d.select("id", base.alias("base"), spans_of(F.col("t"), CANDIDATE, 0, 16, "random", len(PATTERNS)).alias("maybe"))
    if found:
        # exact repeats of a token are tested once; the join key is the token itself
        clear = F.filter("maybe", lambda m: (_encoding(_bare(m["found"])).isNotNull()) & ~_bare(m["found"]).rlike(NUMBER) & ~F.exists(
            "base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
        d = d.select("id", "base", F.filter(clear, lambda m: _passes(_bare(m["found"]), found)).alias("more"))
    else:
        d = d.select("id", "base", F.slice("maybe", 1, 0).alias("more"))
    order = F.array_sort(F.concat("base", "more"))
    return d.select(F.col("id").alias(id_col), F.transform(order, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).alias("spans"))


def _passes(token: Column, found: list) -> Column:
    """Whether the token's score is within the limit of its class."""
    own = [(f"{r['encoding']}/{r['len_class']}", r["limit"]) for r in found]
    limit = F.create_map(*[F.lit(x) for pair in own for x in pair])
    key = F.concat_ws("/", _encoding(token), _length_class(F.length(token)).cast("string"))
    return F.coalesce(battery(token, _alphabet(_encoding(token))) <= limit[key], F.lit(False))


def battery(token: Column, alphabet: Column) -> Column:
    """The largest of the three statistics of ``token`` against a random string of ``alphabet``, in steps of 1 / STEPS."""
    def of(x: Column) -> Column:
        n, a, sym = x["n"], x["a"], x["sym"]
        mean = F.aggregate(sym, F.lit(0.0), lambda s, v: s + v) / n
        high = F.size(F.filter(sym, lambda v: v * 2 >= a)).cast("double")
        rest = F.slice(sym, F.lit(2), F.size(sym) - 1)
        runs = F.aggregate(rest, F.struct(F.get(sym, F.lit(0)).alias("p"), F.lit(1.0).alias("r")), lambda s, v: F.struct(
            v.alias("p"), (s["r"] + F.when((v * 2 >= a) == (s["p"] * 2 >= a), 0.0).otherwise(1.0)).alias("r")), lambda s: s["r"])

        def tests(m: Column) -> Column:
            lagged = F.aggregate(rest, F.struct(F.get(sym, F.lit(0)).alias("p"), F.lit(0.0).alias("r")), lambda s, v: F.struct(
                v.alias("p"), (s["r"] + (v - m["mean"]) * (s["p"] - m["mean"])).alias("r")), lambda s: s["r"])
            spread = F.aggregate(sym, F.lit(0.0), lambda s, v: s + (v - m["mean"]) * (v - m["mean"]))
            twice = m["high"] * 2 * (n - m["high"]) / n
            chi = (a * x["squares"] / n - n - (a - 1)) / F.sqrt((a - 1) * 2 * (n - 1) / n)
            walk = F.when((m["high"] == 0) | (m["high"] == n), F.sqrt(n)).otherwise(
                F.abs(m["runs"] - 1 - twice) / F.sqrt(F.greatest(twice * (twice - 1) / (n - 1), F.lit(1e-9))))
            lag = let(spread, lambda v: F.when(v == 0, F.sqrt(n)).otherwise(F.abs(lagged / v + 1 / (n - 1)) * F.sqrt(n)))
            return F.ceil(F.greatest(chi, walk, lag, F.lit(0.0)) * STEPS)

        return let(F.struct(mean.alias("mean"), high.alias("high"), runs.alias("runs")), tests)

    chars = F.split(token, "")
    squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s + F.pow(
        F.length(token) - F.length(F.replace(token, c, F.lit(""))), F.lit(2.0)))
    sym = let(alphabet, lambda al: F.transform(chars, lambda c: (F.instr(al, c) - 1).cast("double")))
    return let(F.struct(F.length(token).cast("double").alias("n"), F.length(alphabet).cast("double").alias("a"),
                        sym.alias("sym"), squares.alias("squares")), of)
