"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every text is measured once (counts per document, no shuffle).  For each stratum
and rule, labelled good rows decide how strict a cutoff may be: cutoffs are
tried from lenient to strict, and one is certified while an exact binomial test
rejects "more than ``risk`` of good rows fail".  The error level is shared over all
(stratum, rule) pairs (Bonferroni); along one pair's fixed order of cutoffs
testing stops at the first failure, which needs no further correction.  Of the
certified cutoffs the most lenient one that removes the most labelled bad rows
is used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = "[ \\\\t-\\\\r]"
SYMBOLS = "[#*$%&|<>]"

#: rule: numerator, denominator, cutoffs in thousandths from lenient to strict
RULES: dict[str, tuple[str, str, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "word_chars", (400, 300, 250, 200, 150, 100, 75, 50, 30, 20, 10)),
    "dup_lines": ("n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400, 300, 200, 150, 100)),
    "repeat_words": ("n_repeat_words", "n_words", (450, 400, 350, 300, 250, 200, 150, 100, 75, 50)),
    "word_length": ("word_chars", "n_words", (20000, 16000, 14000, 12000, 11000, 10000, 9000, 8000)),
}


def measure(docs: DataFrame, *, text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """Counts of every whole text beside the columns of ``keep``; null text counts as empty.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines
    (lines with a word), all long.  Windows of three words are compared by a
    64-bit hash whose low bits are replaced by the window's place: sorting those
    numbers brings equal windows together.  Only windows with an equal hash
    neighbour are compared as text, so the counts are exact.
    """
    keep = keep or {}
    names = list(keep)
    kept = [F.col(f"k{i}") for i in range(len(names))]
    cut = docs.select(
        *(c.alias(f"k{i}") for i, c in enumerate(keep.values())), F.coalesce(F.col(text_col), F.lit("")).alias("t")
    ).select(
        *kept, F.expr(f"array_remove(split(t, '{BLANKS}+'), '') AS w"),
        F.expr(f"size(split(t, '{SYMBOLS}', -1)) - 1 AS n_symbols"),
        F.expr(f"filter(split(t, '\\n'), x -> x rlike '[^{BLANKS[1:]}') AS l"),
    )
    counted = cut.select(
        *kept, "w", "n_symbols", F.expr("size(w) AS n"), F.expr("length(array_join(w, '')) AS word_chars"),
        F.expr("size(l) AS n_lines"), F.expr("size(l) - size(array_distinct(l)) AS n_dup_lines"),
        # bits that hold a window's place
        F.expr("cast(ceil(log2(size(w) + 1)) AS int) AS b"),
    )
    rest = ("n", "word_chars", "n_symbols", "n_lines", "n_dup_lines")
    hashed = counted.select(*kept, *rest, "w", "b", F.expr(
        """sort_array(CASE WHEN n >= 3 THEN transform(sequence(0, n - 3), i ->
             shiftleft(shiftright(xxhash64(w[i], w[i + 1], w[i + 2]), b), b) | cast(i AS bigint))
           ELSE cast(array() AS array<bigint>) END) AS h"""))
    suspects = hashed.select(*kept, *rest, "w", "b", F.expr(
        """filter(h, (x, j) -> coalesce(shiftright(get(h, j + 1), b) = shiftright(x, b), false)
                            OR coalesce(shiftright(get(h, j - 1), b) = shiftright(x, b), false)) AS s"""))
    spelled = suspects.select(*kept, *rest, F.expr(
        """sort_array(transform(transform(s, x -> cast(x & (shiftleft(1L, b) - 1) AS int)), i ->
             struct(concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS t, i AS i))) AS e"""))
    places = spelled.select(*kept, *rest, F.expr(
        """sort_array(transform(filter(e, (x, j) -> coalesce(get(e, j + 1).t = x.t, false)
                                                 OR coalesce(get(e, j - 1).t = x.t, false)), x -> x.i)) AS p"""))
    return places.select(
        *(F.col(f"k{i}").alias(n) for i, n in enumerate(names)), F.col("n").cast("long").alias("n_words"),
        *(F.col(c).cast("long").alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines")),
        # a window covers three words, or those up to the next repeated window
        F.expr("""aggregate(transform(p, (x, j) -> coalesce(least(3, get(p, j + 1) - x), 3)), 0L, (a, x) -> a + x)
                  AS n_repeat_words"""),
        F.col("n_lines").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P[X <= k] for X ~ Binomial(n, p), summed from the largest term down."""
    if k >= n:
        return 1.0
    log_term = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    if k > n * p:
        # beyond the mode: one minus the upper tail, whose terms fall from k + 1 on
        up = math.exp(log_term) * (n - k) / (k + 1) * p / (1 - p)
        total, j = 0.0, k + 1
        while up > total * 1e-17 and j <= n:
            total += up
            up *= (n - j) / (j + 1) * p / (1 - p)
            j += 1
        return max(0.0, 1.0 - total)
    term = math.exp(log_term)
    total, j = 0.0, k
    while j >= 0 and term > total * 1e-17:
        total += term
        term *= j / (n - j + 1) * (1 - p) / p
        j -= 1
    return min(1.0, total)


@dataclass
class Cutoffs:
    """Certified cutoff in thousandths by (stratum, rule); a missing pair rejects nothing."""

    values: dict[tuple[str, str], int]
    risk: float
    level: float

    def verdict(self, stratum: Column) -> Column:
        """True where a certified cutoff of the row's stratum is exceeded."""
        failed = F.lit(False)
        for (name, rule), cutoff in sorted(self.values.items()):
            over, under, _ = RULES[rule]
            failed = failed | ((stratum == name) & (1000 * F.col(over) > cutoff * F.col(under)))
        return failed


def choose(counts: dict[str, dict[str, int]], risk: float, level: float) -> Cutoffs:
    """Cutoffs from the counts of ``tally``: per stratum good, bad, and <rule>_<cutoff>_<good|bad> rows over it."""
    tested = [s for s in sorted(counts) if counts[s]["good"]]
    each_level = level / max(1, len(tested) * len(RULES))
    each_risk = risk / len(RULES)  # a row may fail any rule, so the rules share the risk
    chosen = {}
    for s in tested:
        c = counts[s]
        for rule, (_, _, cutoffs) in RULES.items():
            best = None
            for cutoff in cutoffs:
                if binomial_at_most(c[f"{rule}_{cutoff}_good"], c["good"], each_risk) > each_level:
                    break
                removed = c[f"{rule}_{cutoff}_bad"]
                if best is None or removed > best[1]:
                    best = (cutoff, removed)
            if best is not None:
                chosen[s, rule] = best[0]
    return Cutoffs(chosen, risk, level)


def tally(measured: DataFrame, good: Column, stratum: Column) -> dict[str, dict[str, int]]:
    """One aggregate over the labelled rows; a row per stratum comes back."""
    sums = [F.sum(good.cast("long")).alias("good"), F.sum((~good).cast("long")).alias("bad")]
    for rule, (over, under, cutoffs) in RULES.items():
        for cutoff in cutoffs:
            beyond = 1000 * F.col(over) > cutoff * F.col(under)
            sums += [F.sum((good & beyond).cast("long")).alias(f"{rule}_{cutoff}_good"),
                     F.sum((~good & beyond).cast("long")).alias(f"{rule}_{cutoff}_bad")]
    rows = measured.groupBy(stratum.alias("stratum")).agg(*sums).collect()
    return {r["stratum"]: r.asDict() for r in rows}


def calibrate(measured: DataFrame, labels: DataFrame, *, risk: float = 0.02, level: float = 0.05) -> Cutoffs:
    """Cutoffs from all labelled rows of ``measured`` (columns doc_id, stratum and the counts).

    ``labels``: doc_id and boolean good; null ids and labels are left out, a
    repeated id counts once and is good only if all its labels are.  Rows that
    fail the base rules are settled already and take no part.  Guarantee: with
    probability 1 - ``level`` over the labelled rows, at most ``risk`` of the good rows
    of every stratum fail a cutoff.  Where a stratum has too few good rows its
    verdict is empty: with the default risk and level, and none of them over a
    cutoff, 875, 1,013, 1,094 and 1,151 good rows are needed with one to four strata.
    """
    marked = labels.filter("doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    rows = measured.filter(~base_failed()).join(marked, "doc_id")
    return choose(tally(rows, F.col("good"), F.col("stratum")), risk, level)
