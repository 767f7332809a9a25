"""Quality rules with risk-controlled thresholds, in DataFrame expressions only.

Every rule is a ratio of two counts of the text that must not exceed a cutoff. The cutoffs come from labelled holdouts.
Per stratum the rules in use are those whose strictest cutoff rejects ``USEFUL`` percent or more of the bad documents. Step
by step, from the mildest cutoffs to the strictest, the rules in use are tried together, and a step is admissible while the
exact binomial test rejects "more than ``alpha`` of the good documents would go". Trying in a fixed order and stopping at the
first failure needs no correction along the steps; over strata the test level is ``delta / strata`` (Bonferroni). The rules
in use are told by bad documents alone and the tests read good ones alone, so that choosing them costs no error. So with
probability 1 - delta, in every stratum at once, all rules together drop at most ``alpha`` of the good documents. Among
the admissible steps the one with the best difference of rejection rates (bad minus good) is taken, the mildest among
equals; a stratum with too few labels to prove anything (86 good ones without an error, of four strata) gets no cutoff and
loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.session import ensure_checkpoint_dir

#: Words are runs of other characters than these.
SPACE, WORD = "[\\x20\\x09-\\x0D]+", "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
#: rule -> (numerator, denominator, cutoffs in percent, mildest first)
RULES = {
    "symbols": ("n_symbols", "n_words", (200, 100, 50, 25, 10)),
    "marks": ("n_marks", "n_words", (150, 100, 75, 50, 25)),
    "capitals": ("n_upper", "word_chars", (80, 60, 40, 30)),
    "lines": ("n_dup_lines", "n_lines", (80, 60, 40, 30)),
    "repeats": ("n_repeat_words", "n_words", (25, 20, 15, 10)),
    "word_length": ("word_chars", "n_words", (4000, 2500, 1600)),
}
STEPS = max(len(grid) for _, _, grid in RULES.values())
#: Share of a stratum's good documents that may go, and the chance that this is exceeded anywhere.
ALPHA, DELTA = 0.05, 0.05
#: Percent of a stratum's bad documents that a rule must reject at its strictest to be in use there.
USEFUL = 2
#: Up to this many strata the cutoffs travel as literals of the plan, beyond it they are joined.
LITERAL_STRATA = 500
COUNTS = ["n_words", "word_chars", "n_symbols", "n_marks", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words"]


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value computed once, also where f uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), f), 1)


def with_window_hashes(df: DataFrame, words: str, out: str) -> DataFrame:
    """``df`` with the 64-bit hashes of all windows of WINDOW (a power of two) words: hashes of words, pairs of neighbours,
    pairs of pairs and so on. Each step is a projection of its own, which Spark does not fold into the next one's lambda."""
    rest = [c for c in df.columns if c != words]
    df = df.select(*rest, F.size(words).alias("_n"), F.transform(words, lambda w: F.xxhash64(w)).alias(out))
    step = 1
    while step < WINDOW:
        df = df.select(*rest, "_n", _neighbours(out, step).alias(out))
        step *= 2
    return df.select(*rest, F.slice(F.col(out), F.lit(1), F.greatest(F.col("_n") - (WINDOW - 1), F.lit(0))).alias(out))


def _neighbours(hashes: str, step: int) -> Column:
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step)))


def repeat_words(hashes: Column) -> Column:
    """Words in windows that occur twice or more, from the hashes of all windows. Most texts have none and stop at the
    distinct count; in the others equal windows are found by sorting, n log n."""
    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.get(at, k + 1) - p))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def again(s: Column) -> Column:
        same = F.filter(s, lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)))
        return let(F.sort_array(F.transform(same, lambda e: e["i"])), covered)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, again))


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(id, stratum, counts of COUNTS, base_failed) of each whole text; null text has no words, a null stratum is ''."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"), text.alias("t"))
    times = lambda signs: F.regexp_count("t", F.lit(signs))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    d = d.select("id", "stratum", F.array_remove(F.split("t", SPACE), "").alias("words"), lines.alias("lines"),
                 times(SYMBOLS).alias("n_symbols"), times("[!?]").alias("n_marks"), times("[A-Z]").alias("n_upper"))
    d = d.select("id", "stratum", F.size("words").alias("n_words"), "words",
                 F.char_length(F.array_join("words", "")).alias("word_chars"), "n_symbols", "n_marks", "n_upper",
                 F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"))
    d = with_window_hashes(d, "words", "hashes").withColumn("n_repeat_words", repeat_words(F.col("hashes")))
    return d.select("id", "stratum", *[F.col(c).cast("long") for c in COUNTS]).withColumn(
        "base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))


def rejects(rule: str, percent: Column) -> Column:
    top, bottom, _ = RULES[rule]
    return F.col(top) * 100 > percent * F.col(bottom)


def at(rule: str, step: int) -> int:
    """The cutoff of a rule at a step; a rule with fewer stays at its strictest."""
    return RULES[rule][2][min(step, len(RULES[rule][2]) - 1)]


def lower_tail(n: Column, k: Column, p: float) -> Column:
    """P(a binomial count of n trials of chance p is at most k), exactly summed from its largest term down; 1 beyond
    the mean, where no test passes. The terms grow up to k, so none is lost in the smallest doubles."""
    odds = p / (1 - p)
    last = lambda n, k: n * F.log(F.lit(1 - p)) + F.aggregate(
        F.sequence(F.lit(0).cast("long"), k), F.lit(0.0),
        lambda a, i: a + F.when(i > 0, F.log((n - i + 1) / F.greatest(i, F.lit(1)) * odds)).otherwise(0.0))
    below = lambda n, k: F.aggregate(
        F.sequence(F.lit(0).cast("long"), k), F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
        lambda a, j: F.struct((a["t"] * (k - j) / ((n - k + j + 1) * odds)).alias("t"), (a["s"] + a["t"]).alias("s")),
        lambda a: a["s"])
    return F.when(k >= n * p, 1.0).otherwise(F.exp(last(n, k) + F.log(below(n, k))))


def cutoffs(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
            alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, percent): the risk-controlled cutoffs from labels (1 good, 0 bad; other values are no label).

    A document labelled twice counts once, as bad if any of its labels says so. Strata without good or bad documents or
    without an admissible step and rules that are not in use have no row; without labels the result is empty.
    """
    ensure_checkpoint_dir(measured.sparkSession)
    marked = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("good"))
    # bit i of a step's mask: rule i rejects at that step
    masks = [F.reduce(F.array(*[F.when(rejects(r, F.lit(at(r, s))), 1 << i).otherwise(0) for i, r in enumerate(RULES)]),
                      F.lit(0), lambda a, x: a + x) for s in range(STEPS)]
    counted = measured.join(marked, "id").groupBy("stratum", "good", F.array(*masks).alias("masks")).count().checkpoint()
    bits = F.explode(F.sequence(F.lit(0), F.lit(len(RULES) - 1))).alias("bit")
    bad = counted.where("good = 0")
    useful = bad.select("stratum", "masks", "count", bits).groupBy("stratum", "bit").agg(
        F.sum(F.when(F.expr(f"getbit(masks[{STEPS - 1}], bit) = 1"), F.col("count")).otherwise(0)).alias("caught"),
        F.sum("count").alias("n")).where(f"caught * 100 >= n * {USEFUL}").groupBy("stratum").agg(
        F.sum(F.call_function("shiftleft", F.lit(1), F.col("bit"))).cast("int").alias("used"))
    strata = counted.agg(F.count_distinct("stratum")).scalar()
    seen = counted.join(useful, "stratum").select(
        "stratum", "good", "count", "used", F.posexplode("masks").alias("step", "mask")).groupBy("stratum", "used", "step").agg(
        *[F.coalesce(F.sum(F.when(F.expr(f"good = {g} AND {x}"), F.col("count"))), F.lit(0)).alias(name)
          for name, g, x in (("n_good", 1, "true"), ("n_bad", 0, "true"), ("k", 1, "mask & used != 0"), ("caught", 0, "mask & used != 0"))])
    t = seen.where("n_good > 0").withColumn(
        "fails", (lower_tail(F.col("n_good"), F.col("k"), alpha) > F.lit(delta) / strata).cast("int"))
    failed = F.sum("fails").over(Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    gain = (F.col("caught") / F.col("n_bad") - F.col("k") / F.col("n_good")).alias("gain")
    best = F.max(F.struct(gain, (-F.col("step")).alias("mild"))).alias("best")
    best = t.withColumn("failed", failed).where("failed = 0 AND caught > 0").groupBy("stratum", "used").agg(best).where("best.gain > 0")
    percents = F.array(*[F.array(*[F.lit(at(r, s)).cast("long") for s in range(STEPS)]) for r in RULES])
    names = F.array(*[F.lit(r) for r in RULES])
    return best.select("stratum", "used", (-F.col("best.mild")).alias("step"), bits).where("getbit(used, bit) = 1").select(
        "stratum", F.get(names, F.col("bit")).alias("rule"), F.get(F.get(percents, F.col("bit")), F.col("step")).alias("percent"))


def judge(measured: DataFrame, found: DataFrame) -> DataFrame:
    """``measured`` with ``kept``: neither base_failed nor beyond a cutoff of its stratum."""
    wide = found.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "percent"))).alias("cut"))
    rows = wide.limit(LITERAL_STRATA + 1).collect()
    broken = lambda limit: F.coalesce(F.reduce(F.array(*[
        F.coalesce(rejects(r, limit(r)), F.lit(False)) for r in RULES]), F.lit(False), lambda a, x: a | x), F.lit(False))
    if len(rows) > LITERAL_STRATA:
        d = measured.join(wide, "stratum", "left").withColumn("kept", ~(F.col("base_failed") | broken(lambda r: F.col("cut")[r])))
        return d.drop("cut")

    def limit(rule: str) -> Column:
        own = [(r["stratum"], r["cut"][rule]) for r in rows if rule in r["cut"]]
        if not own:
            return F.lit(None).cast("long")
        return F.create_map(*[F.lit(x) for pair in own for x in pair])[F.col("stratum")]

    return measured.withColumn("kept", ~(F.col("base_failed") | broken(limit)))


def verdicts(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(id, stratum, counts, base_failed, kept) per row of ``documents``; repeated rows and null ids stay, other columns
    are not read. An empty table gives an empty one. Null text: no words, so base_failed."""
    ensure_checkpoint_dir(documents.sparkSession)
    d = measures(documents, id_col, text_col, stratum_col).checkpoint()  # numbers only; the texts are read once
    return judge(d, cutoffs(d, labels, id_col, alpha=alpha, delta=delta))


def keep(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``documents`` that are kept, all columns. The verdict is computed beside the text, without a join."""
    found = cutoffs(measures(documents, id_col, text_col, stratum_col), labels, id_col, alpha=alpha, delta=delta)
    whole = documents.select(F.struct("*").alias("row"))
    inner = whole.select("row", F.col(f"row.`{id_col}`").alias(id_col), F.col(f"row.`{text_col}`").alias(text_col),
                         F.col(f"row.`{stratum_col}`").alias(stratum_col))
    judged = judge(_measured_beside(inner, id_col, text_col, stratum_col), found)
    # the running number keeps Spark from moving the filter below the steps that compute the verdict, where these would
    # be folded into one expression and evaluated again for every word
    return judged.withColumn("_at", F.monotonically_increasing_id()).where("kept AND _at >= 0").select("row.*")


def _measured_beside(df: DataFrame, id_col: str, text_col: str, stratum_col: str) -> DataFrame:
    """``measures`` with the column ``row`` carried along in the id."""
    return measures(df.select(F.struct("row").alias(id_col), text_col, stratum_col), id_col, text_col, stratum_col).withColumn(
        "row", F.col("id.row"))
