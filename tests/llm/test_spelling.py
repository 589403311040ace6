import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from zonecast.llm import spelling

from .helpers import collected, frame


def plain_words(docs, thin=31, letters=7, least=2):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if key is not None and thin and (h := zlib.crc32(f"{key}:{run}".encode())) % thin == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= letters:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= least}


def near(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(words, ratio=10):
    out = {}
    for w, n in words.items():
        others = [(-words[x], x) for x in words if near(w, x)]
        form = min(others)[1] if others and -min(others)[0] >= ratio * n else None
        out[w] = [form, n, len(others), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def made_docs(seed=1):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdéß", k=rng.randint(6, 10))) for _ in range(40)]
    docs = []
    for key in range(120):
        words = []
        for _ in range(60):
            w = base[min(39, int(rng.expovariate(0.25)))]
            if rng.random() < 0.15:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcdÿ") + w[i + 1:], w[:i] + rng.choice("abcd") + w[i:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((key, " ".join(words)))
    return docs


@pytest.fixture(scope="module")
def edge_docs():
    long = "qwertzu" * 3000
    return made_docs() + [
        (None, "abcdabcd " * 25), (500, None), (501, ""), (502, "12 34, ..."), (503, "aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa"),
        (504, f"{long} {long}x {long}"), (504, f"{long}x"), (505, "ÀÀÀÀÀÀÀÀ àààààààà ÷÷÷÷÷÷÷÷ " * 2), (505, "ÀÀÀÀÀÀÀÀ àààààààà ÷÷÷÷÷÷÷÷ " * 2),
    ]


@pytest.mark.parametrize("pass_words", [spelling.PASS_WORDS, 20])
def test_variants_equal_all_pairs(spark, edge_docs, monkeypatch, pass_words):
    """Also with a vocabulary that takes many passes, and lengths split over several filters."""
    monkeypatch.setattr(spelling.near_words, "__defaults__", (pass_words,))
    df = frame(spark, edge_docs, [("word", "x"), ("n", 1), ("near", "y"), ("root", "z")])
    got = collected(spelling.variants(df))
    want = plain_variants(plain_words(edge_docs))
    assert {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"], r["root"]) for r in got} == want
    assert len(got) == len(want) and sum(v[0] is not None for v in want.values()) > 20


def test_chains_of_forms(spark):
    """A word's form has a form itself: the root is the last one."""
    docs = [(n, " ".join(["abcdefgh"] * a + ["abcdefgx"] * b + ["abcdefyx"] * c)) for n, (a, b, c) in enumerate([(600, 20, 2), (600, 20, 0)])]
    got = {r["word"]: r for r in collected(spelling.variants(frame(spark, docs), thin=0))}
    assert got["abcdefyx"]["form"] == "abcdefgx" and got["abcdefyx"]["root"] == "abcdefgh" == got["abcdefgx"]["root"]
    assert got["abcdefgh"]["form"] is None and got["abcdefgx"]["n_near"] == 2


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, ""), (3, "once"), (None, None)]):
        df = spelling.variants(frame(spark, rows))
        assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and df.count() == 0


def test_filters_miss_no_word_and_few_others():
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(7, 70))) for _ in range(20_000)})
    sizes = Counter(min(len(w), spelling.LONG) for w in words)
    for shards in spelling._passes(sizes, 4000):
        filters = spelling.Filters(shards)
        hashes = {}
        for at, codes in spelling._by_length(words):
            z = spelling._mixed((codes * spelling._powers(codes.shape[1])).sum(axis=1, dtype=np.uint64))
            hashes.setdefault(codes.shape[1], []).append(z)
            for _, block, h in filters.places(codes.shape[1], z):
                for j in range(spelling.PROBES):
                    i, place = filters.bit(block, h, j)
                    np.bitwise_or.at(filters.bits, i, np.uint64(1) << place)
        for length, zs in hashes.items():
            z = np.concatenate(zs)
            inside = np.concatenate([w for w, _, _ in filters.places(length, z)] or [np.zeros(0, np.int64)])
            assert set(inside.tolist()) <= set(filters.hold(length, z).tolist())
            other = np.asarray([rng.getrandbits(64) for _ in range(3000)], np.uint64)
            assert len(filters.hold(length, other)) < 100
    parts = [s for p in spelling._passes(sizes, 4000) for s in p]
    assert {s[0] for s in parts} == set(sizes) and all(sum(x[3] for x in p) <= 4000 + len(p) for p in spelling._passes(sizes, 4000))
