"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

``measures`` counts what the rules look at, within each row, so that it needs no shuffle.  ``cutoffs`` chooses cutoffs for each stratum
(a band of text lengths): the labelled good documents are a holdout.  All cutoffs of all rules form one path, fixed beforehand, on which the rules take turns and each goes from its most
lenient cutoff to its strictest.  At each step a document is rejected if any cutoff up to there rejects it; so the steps' rejected sets are nested, and each
is certified as a whole while the exact binomial tail P(Bin(n, risk) <= rejected good) is at most delta / strata.  The sequence
ends at the first step that is not (fixed-sequence testing within a stratum, Bonferroni between strata).  So with
probability 1 - delta the rules together reject no more than ``risk`` of the good documents of any stratum.  Of the certified steps the one with the best
balance of rejected bad and good documents is used, the most lenient of equals; without gain there is none.
All labelled rows count; what is gathered has a row for each stratum and step.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cutoffs of each rule from lenient to strict: a text fails whose measure is as large.
GRID: dict[str, list[float]] = {
    "symbols_per_word": [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1],
    "duplicate_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2],
    "repeated_words": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15],
    "word_length": [30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0],
    "exclamations": [2.0, 1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1],
    "upper_case": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
}
#: Upper ends, in words, of the bands of text lengths; the last band has no end.
BANDS = [150, 400, 1000]
RISK, DELTA = 0.02, 0.05
#: Rejected bad documents that a rejected good one weighs as much as.
PRICE = 10
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """Binds an array or struct to a variable, so that it is computed once however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more, from the array of words. Windows are compared by 64-bit hashes."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def places(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            equal = lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
            where = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: F.coalesce(equal(k, k - 1), F.lit(False)) | F.coalesce(equal(k, k + 1), F.lit(False)))
            return F.sort_array(F.transform(where, lambda k: F.get(s, k)["i"]))

        return let(ranked, twice)

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda a, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - a, F.lit(3))))
        return F.aggregate(step, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(let(places(h), covered))

    return F.when(n < 3, F.lit(0).cast("bigint")).otherwise(let(hashes, count))


def measures(df: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The counts of every whole text: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``n_lines``, ``n_exclamations``, ``n_upper``, and ``base_failed``.

    A null text counts as an empty one. ``keep``: the columns that stay, all by default; one that is named as a count gives way to it.
    """
    keep = df.columns if keep is None else keep
    own = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    t = F.coalesce(F.col("t"), F.lit(""))
    split = df.select(*own, F.col(f"`{text}`").cast("string").alias("t")).withColumns({"w": F.array_remove(F.split(t, SPACE), ""), "l": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    long = lambda c: c.cast("bigint")
    counts = {
        "n_words": long(F.size("w")),
        "word_chars": long(F.length(F.array_join("w", ""))),
        "n_symbols": long(F.regexp_count(t, F.lit(r"[#*$%&|<>]"))),
        "n_dup_lines": long(F.size("l") - F.size(F.array_distinct("l"))),
        "n_repeat_words": repeated_words(F.col("w")),
        "n_lines": long(F.size("l")),
        "n_exclamations": long(F.regexp_count(t, F.lit("!"))),
        "n_upper": long(F.regexp_count(t, F.lit("[A-Z]"))),
    }
    out = split.select(*[F.col(f"k{i}") for i in range(len(keep))], *[c.alias(n) for n, c in counts.items()])
    out = out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    new = [*counts, "base_failed"]
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep) if c not in new], *new)


def rule_measures() -> dict[str, Column]:
    """What each rule of the grid compares, from the counts."""
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return {
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "duplicate_lines": ratio("n_dup_lines", "n_lines"),
        "repeated_words": ratio("n_repeat_words", "n_words"),
        "word_length": ratio("word_chars", "n_words"),
        "exclamations": ratio("n_exclamations", "n_words"),
        "upper_case": ratio("n_upper", "word_chars"),
    }


def stratum(bands: list[int]) -> Column:
    """The number of the band of text lengths."""
    return sum(((F.col("n_words") >= b).cast("int") for b in bands), F.lit(0))


def log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series, exact for small x."""
    y = F.greatest(x, F.lit(10.0))
    series = y * F.ln(y) - y + 0.5 * F.ln(2 * math.pi * y) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return F.when(x < 10, F.ln(F.factorial(x.cast("int")).cast("double"))).otherwise(series)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed downward from k until terms no longer count in a double; 1 where k is n p or more."""

    def tail(x: Column) -> Column:
        k, n, steps = x["k"], x["n"], x["steps"]
        head = log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * math.log(p) + (n - k) * math.log1p(-p)
        start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

        def add(s: Column, i: Column) -> Column:
            j = k - i + 1
            term = s["term"] * j * (1 - p) / ((n - j + 1) * p)
            return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

        total = F.when(steps < 1, F.lit(1.0)).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, add, lambda s: s["total"]))
        return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(head) * total)

    k, n = k.cast("double"), n.cast("double")
    steps = F.least(k, F.ceil(9 * F.sqrt(n * p)) + 50).cast("int")
    return let(F.struct(k.alias("k"), n.alias("n"), steps.alias("steps")), tail)


def path_of(grid: dict[str, list[float]]) -> dict[str, list[int]]:
    """The step of each cutoff on the common path: by its place among its rule's, then by rule."""
    order = sorted((i / len(cutoffs), k, i, rule) for k, (rule, cutoffs) in enumerate(grid.items()) for i in range(len(cutoffs)))
    steps: dict[str, list[int]] = {rule: [] for rule in grid}
    for n, (_, _, _, rule) in enumerate(order, 1):
        steps[rule].append(n)
    return steps


def cutoffs(counted: DataFrame, labels: DataFrame, *, doc: str = "doc_id", label: str = "quality", risk: float = RISK, delta: float = DELTA, bands: list[int] | None = None, grid: dict[str, list[float]] | None = None) -> DataFrame:
    """A row for each stratum and rule that rejects some of it: ``stratum``, ``rule``, ``cutoff``, and of the stratum's rules together ``n_good``, ``good_rejected``, ``bad_rejected``, ``tail``.

    ``counted`` is what ``measures`` returns, stored (else it counts anew). A document with several labels counts as good if one says so; rows that ``base_failed`` aren't
    part of the holdout. Null labels and ids don't count; repeated rows count each. Without labels, or with too few for a certificate, there are no rows.
    """
    bands, grid = bands or BANDS, grid or GRID
    marks = labels.select(F.col(f"`{doc}`").alias("d"), F.col(f"`{label}`").alias("q")).dropna().groupBy("d").agg((F.max("q") > 0).alias("good"))
    measured, steps = rule_measures(), path_of(grid)
    never = sum(map(len, grid.values())) + 1
    # the first step at which a rule rejects: that of its most lenient cutoff that is reached
    own = {r: F.coalesce(*[F.when(measured[r] >= c, F.lit(n)) for c, n in zip(grid[r], steps[r], strict=True)], F.lit(never)) for r in grid}
    rows = counted.where(~F.col("base_failed")).select(F.col(f"`{doc}`").alias("d"), stratum(bands).alias("stratum"), *[own[r].alias(r) for r in grid])
    held = rows.join(marks, "d").withColumn("step", F.least(*grid))
    by_step = held.groupBy("stratum", "step").agg(F.sum(F.col("good").cast("bigint")).alias("g"), F.sum((~F.col("good")).cast("bigint")).alias("b"), *[F.min(r).alias(r) for r in grid])
    # rows of a stratum are as many as steps, at most
    every = Window.partitionBy("stratum")
    upto = every.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    path = by_step.withColumns({"n_good": F.sum("g").over(every), "good_rejected": F.sum("g").over(upto), "bad_rejected": F.sum("b").over(upto), **{r: F.min(r).over(every) for r in grid}}).where(F.col("step") < never)
    path = path.withColumn("tail", binomial_tail(F.col("good_rejected"), F.col("n_good"), risk))
    gain = F.col("bad_rejected") - PRICE * F.col("good_rejected")
    certified = path.withColumn("open", F.min((F.col("tail") <= delta / (len(bands) + 1)).cast("int")).over(upto)).where((F.col("open") == 1) & (gain > 0))
    best = certified.groupBy("stratum").agg(F.max(F.struct(gain.alias("gain"), (-F.col("step")).alias("back"), "step", "n_good", "good_rejected", "bad_rejected", "tail", *grid)).alias("x"))
    rules = [F.struct(F.lit(r).alias("rule"), F.get(F.array(*[F.lit(float(c)) for c in grid[r]]), F.size(F.filter(F.array(*[F.lit(n) for n in steps[r]]), lambda n: n <= F.col("x.step"))) - 1).alias("cutoff"), F.col(f"x.{r}").alias("first")) for r in grid]
    return best.withColumn("r", F.explode(F.array(*rules))).where("r.first <= x.step").select("stratum", "r.rule", "r.cutoff", "x.n_good", "x.good_rejected", "x.bad_rejected", "x.tail")


def judged(counted: DataFrame, chosen: DataFrame, *, bands: list[int] | None = None, grid: dict[str, list[float]] | None = None) -> DataFrame:
    """Adds ``kept`` to the counts: false if ``base_failed`` or if a measure reaches its stratum's cutoff.

    ``chosen`` has a row for each band and rule at most; those few rows are read by the driver and become part of the expression.
    """
    bands, grid = bands or BANDS, grid or GRID
    found = {(r["stratum"], r["rule"]): r["cutoff"] for r in chosen.select("stratum", "rule", "cutoff").collect()}
    measured = rule_measures()
    failed = F.col("base_failed")
    for rule in grid:
        at = F.array(*[F.lit(found.get((b, rule))).cast("double") for b in range(len(bands) + 1)])
        failed = failed | F.coalesce(measured[rule] >= F.get(at, stratum(bands)), F.lit(False))
    return counted.select(*[F.col(f"`{c}`") for c in counted.columns if c != "kept"], (~failed).alias("kept"))
