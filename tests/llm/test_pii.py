import hashlib
import itertools
import math
import random
import re

import pytest

from zonecast.llm import pii
from zonecast.llm.pii_base import KINDS, base_spans, cards, emails, ips, joined, luhn, phones

from .helpers import SF, collected, frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def plain(text):
    """The patterns as stated, by the plain expressions."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def test_base_equals_plain_patterns():
    rng = random.Random(2)
    for _ in range(30000):
        text = "".join(rng.choice("aZ0123.@+- ()%é²") for _ in range(rng.randint(0, 40)))
        assert base_spans(text) == plain(text), text


def test_base_is_linear_on_long_runs():
    for unit in ("a", "1", "1.", "+1", "a@", "1 ", "@", "+(", "@a.", "0"):
        text = unit * 200_000
        base_spans(text)
        pii.windows_of(text)
    assert ips("0" * 9000 + "1.2.3.4") and not ips("9" * 9000 + ".2.3.4")
    assert emails("x" * 100_000 + "@a.b") == [(0, 100_004)]
    assert cards("4111 1111-1111 1111") and phones("+1 (377) 555-0271")


@pytest.fixture(scope="module")
def model():
    return pii.fit(pii.examples_from(["the of 1.2.3.4 and", "on a.b@c.org is in", "at +1 (377) 555-0271 to"]))


def segmentations(group):
    """All sets of candidates that do not overlap."""
    for n in range(len(group) + 1):
        for chosen in itertools.combinations(range(len(group)), n):
            spans = sorted((group[i].start, group[i].end) for i in chosen)
            if all(x[1] <= y[0] for x, y in zip(spans, spans[1:])):
                yield chosen


def test_dynamic_programs_equal_enumeration(model):
    rng = random.Random(4)
    tried = 0
    while tried < 60:
        text = "".join(rng.choice(["12 ", "345", ".", " ", "-", "6", "(", "+", "7890"]) for _ in range(9))
        for group in pii.independent(pii.candidates(text)):
            if not 2 <= len(group) <= 11:
                continue
            tried += 1
            scores = [rng.uniform(-3, 3) for _ in group]
            lattice = pii.Lattice(group, scores)
            weight = {c: sum(scores[i] for i in c) for c in segmentations(group)}
            assert sum(scores[i] for i in lattice.best()) == pytest.approx(max(weight.values()))
            total = sum(map(math.exp, weight.values()))
            for i, p in enumerate(lattice.marginals()):
                want = sum(math.exp(w) for c, w in weight.items() if i in c) / total
                assert p == pytest.approx(want, abs=1e-9)


def test_field_finds_respelled_and_leaves_numbers(model):
    rng = random.Random(11)
    found = tried = wrong = 0
    for _ in range(300):
        kind = rng.choice(KINDS)
        new = pii.rewritten(kind, pii._sample_match(kind, rng), rng)
        base, spans = pii.all_spans(f"the word {new} of that.", model)
        if base:
            continue
        tried += 1
        found += (kind, 9, 9 + len(new)) in spans
    for _ in range(300):
        base, spans = pii.all_spans(f"see {pii._harmless(rng)} there", model)
        wrong += spans != base
    assert found / tried >= 0.85 and wrong <= 6


def test_base_spans_stay_and_added_never_overlap(model):
    rng = random.Random(12)
    for _ in range(500):
        text = " ".join(rng.choice(["4111111111111111", "+1 377 555 0271", "1.2.3.4", "(377) 555-0271", "a@b.c", "x at y dot com", "77"]) for _ in range(5))
        base, spans = pii.all_spans(text, model)
        assert base == plain(text) and set(base) <= set(spans)
        for s in set(spans) - set(base):
            assert all(s[2] <= b[1] or b[2] <= s[1] for b in spans if b != s)


def test_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "é a@b.co 1.2.3.4 +123456789"), (3, "é a@b.co 1.2.3.4 +123456789"), (None, "x" * 300_000 + " a@b.co")]
    df = frame(spark, rows, [("spans", 1), ("n_email", None), ("whole", "w")])
    got = collected(pii.find(df, model).select("whole.doc_id", "whole.text", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"))
    assert len(got) == 5
    for r in got:
        base = plain(r["text"] or "")
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in base) for k in KINDS]
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(joined(base).split(",")) <= set(r["spans"].split(","))
    masked = pii.mask(df, model)
    assert masked.columns == df.columns
    by = {(r["doc_id"], r["n_chars"]): r["text"] for r in collected(masked.filter("doc_id is not null"))}
    assert by[3, len("é <EMAIL> <IP> <PHONE>")] == "é <EMAIL> <IP> <PHONE>" and by[2, 0] == ""
    assert collected(masked.filter("doc_id = 1"))[0]["text"] is None
    assert pii.find(frame(spark, []), model).count() == 0
    assert pii.train(frame(spark, [])).weights and pii.train(frame(spark, [(None, None), (1, None)])).weights
    assert pii.masked_text("abcdef", [("ip", 1, 3), ("card", 2, 4)]) == "a<IP>ef"


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in collected(pii.find(docs, pii.train(docs)).select("whole.doc_id", "base_sha256", "spans"))}
    for r in docs.collect():
        base = plain(r.text)
        assert got[r.doc_id]["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert {joined([s]) for s in base} <= set(got[r.doc_id]["spans"].split(","))
