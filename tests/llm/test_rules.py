import math
import random
import re

import pytest
from pyspark.sql import functions as F

from zonecast.llm import rules

from .helpers import SF, collected, frame

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)]


def test_measures_equal_plain(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "a " * 500, "é\x0bé\x0cé é é é", "x y  z", "a|b\n \na|b\na|b "]
    texts += ["".join(rng.choices(["a", "b", "ü", " ", "\n", "#", "\t", "c d e", "\r"], k=rng.randint(0, 120))) for _ in range(300)]
    texts += ["w1 w2 w3 " * 3000 + "end", " ".join(rng.choices([f"v{i}" for i in range(30)], k=5000))]
    rows = list(enumerate(texts))
    got = rules.measure(frame(spark, rows, [("w", 1), ("n", 2), ("t", 3)]), keep={"doc_id": F.col("doc_id")})
    by = {r["doc_id"]: [r[n] for n in NAMES] for r in collected(got)}
    for k, t in rows:
        assert by[k] == plain(t), (k, (t or "")[:60])


def test_binomial_tail():
    for n, p in ((1, 0.5), (10, 0.02), (200, 0.005), (300, 0.4)):
        total = 0.0
        for k in range(n + 1):
            total += math.comb(n, k) * p ** k * (1 - p) ** (n - k)
            assert rules.binomial_at_most(k, n, p) == pytest.approx(total, rel=1e-9, abs=1e-12)
    assert rules.binomial_at_most(0, 10 ** 7, 0.005) == 0.0
    assert rules.binomial_at_most(50_100, 10 ** 7, 0.005) == pytest.approx(0.67, abs=0.05)


def counts(good, bad, over_good, over_bad):
    """Every rule's cutoffs with the same counts, stricter cutoffs with more rows over them."""
    out = {"good": good, "bad": bad}
    for rule, (_, _, cutoffs) in rules.RULES.items():
        for n, c in enumerate(cutoffs):
            out[f"{rule}_{c}_good"], out[f"{rule}_{c}_bad"] = over_good(n), over_bad(n)
    return out


def test_choice_of_cutoffs():
    first = {r: cs[0] for r, (_, _, cs) in rules.RULES.items()}
    # enough clean rows: the most lenient of equally good cutoffs
    got = rules.choose({"en": counts(10_000, 500, lambda n: 0, lambda n: 100)}, 0.02, 0.05).values
    assert got == {("en", r): c for r, c in first.items()}
    # stricter ones remove more, until good rows fail too often
    got = rules.choose({"en": counts(10_000, 500, lambda n: 0 if n < 4 else 200, lambda n: 10 * n)}, 0.02, 0.05).values
    assert got == {("en", r): cs[3] for r, (_, _, cs) in rules.RULES.items()}
    # too few labelled rows prove nothing; a stratum without good rows has no cutoff
    assert rules.choose({"en": counts(100, 5, lambda n: 0, lambda n: 5), "de": counts(0, 9, lambda n: 0, lambda n: 9)}, 0.02, 0.05).values == {}


def test_guarantee_by_simulation():
    """At a true false-rejection rate just over the limit a cutoff is hardly ever certified."""
    rng = random.Random(3)
    risk, level = 0.04, 0.05
    wrong = 0
    for _ in range(300):
        k = sum(rng.random() < 0.0101 for _ in range(2000))
        wrong += bool(rules.choose({"en": counts(2000, 9, lambda n: k, lambda n: 1)}, risk, level).values)
    assert wrong / 300 <= level


def test_verdict_edges_and_labels(spark):
    junk = "word*** " * 3
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en") for i in range(2500)]
    rows += [(5000 + i, " ".join(f"w{i}x{j}***" for j in range(60)), "en") for i in range(200)]
    rows += [(9000, junk, "en"), (9001, None, None), (9001, None, None), (None, " ".join(f"n{j}***" for j in range(60)), "en"), (9002, " ".join(f"n{j}***" for j in range(60)), "xx")]
    df = frame(spark, rows, [("stratum", 1), ("n_words", 2)])
    measured = rules.measure(df, keep={"doc_id": F.col("doc_id"), "stratum": F.coalesce("lang", F.lit("none"))}).cache()
    labels = spark.createDataFrame([(k, k < 5000) for k, _, _ in rows if k is not None] + [(None, True), (1, None), (2, True)], "doc_id long, good boolean")
    cut = rules.calibrate(measured, labels)
    assert ("en", "symbols") in cut.values and all(s == "en" for s, _ in cut.values)
    failed = {r["doc_id"] for r in collected(measured.filter(cut.verdict(F.col("stratum"))))}
    assert set(range(5000, 5200)) <= failed and None in failed and not failed & set(range(2500)) and 9002 not in failed
    empty = rules.calibrate(measured.limit(0), labels)
    assert empty.values == {} and measured.filter(empty.verdict(F.col("stratum"))).count() == 0
    assert rules.calibrate(measured, labels.limit(0)).values == {}
    assert rules.measure(frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules.measure(docs).explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Arrow", "Exchange"))


def test_least_rows_that_certify():
    """The counts that the docstring and the README state."""
    for strata, least in ((1, 875), (2, 1013), (3, 1094), (4, 1151)):
        for n in (least - 1, least):
            tallied = {str(s): counts(n, 9, lambda _: 0, lambda _: 1) for s in range(strata)}
            assert bool(rules.choose(tallied, 0.02, 0.05).values) == (n == least)
