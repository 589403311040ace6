import random
import re

import numpy as np
import pytest
import xxhash

from zonecast.llm import golay, simhash
from zonecast.llm.components import components

from .helpers import SF, collected, frame


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    runs = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hs = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows):
    """rows of (id, print): component id of each row by comparing all pairs."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    a = np.asarray(prints, np.uint64)
    for i, p in enumerate(prints):
        for q in a[i + 1:][np.bitwise_count(a[i + 1:] ^ a[i]) <= 3].tolist():
            root[find(p)] = find(q)
    least = {}
    for k, p in rows:
        if k is not None:
            least[find(p)] = min(k, least.get(find(p), k))
    return [least.get(find(p)) for _, p in rows]


def test_golay_is_perfect():
    assert (golay._ERROR > 0).sum() == 2047
    words = np.arange(1 << 23, dtype=np.uint32)
    assert (np.bincount(golay.decode(words[:: 1])) == 2048).all()


def test_keys_meet_within_three_bits():
    rng = random.Random(5)
    for _ in range(400):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 3)):
            y ^= 1 << b
        where, key = golay.keys(np.asarray([x, y], np.uint64))
        assert set(key[where == 0]) & set(key[where == 1])
        assert len(set(key[where == 0])) == (where == 0).sum() <= 33


def test_fingerprint_equals_plain():
    texts = ["", " \n", "A", "a b", "The cat", "The cat sat\x0b\x0con the  MAT É é", "x " * 50000, "é b c d e"]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == plain_print(t)


def test_buckets_small_and_large(monkeypatch):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = set(base)
    for b in base:
        for _ in range(60):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << bit
            prints.add(x)
    prints = np.sort(np.asarray(sorted(prints), np.uint64))

    def groups(edges):
        rows = [(i, int(p)) for i, p in enumerate(prints)]
        root = {p: p for _, p in rows}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for xs, ys in edges:
            for x, y in zip(xs.tolist(), ys.tolist()):
                root[find(x)] = find(y)
        out = {}
        for i, p in rows:
            out.setdefault(find(p), set()).add(i)
        return sorted(map(sorted, out.values()))

    want = {}
    for i, c in enumerate(plain_components([(i, int(p)) for i, p in enumerate(prints)])):
        want.setdefault(c, set()).add(i)
    want = sorted(map(sorted, want.values()))
    assert groups(simhash.bucket_edges(prints, 3)) == want
    monkeypatch.setattr(simhash, "LARGE_BUCKET", 10)
    assert groups(simhash.bucket_edges(prints, 3)) == want


def test_components_chain_and_hub(spark):
    edges = [(i + 1, i) for i in range(30)] + [(1000 + i, 999) for i in range(50)] + [(5000, 10), (5000, 4000)]
    df = spark.createDataFrame(edges, "hi long, lo long")
    got = {r["node"]: r["root"] for r in collected(components(df))}
    assert all(got[i] == 0 for i in range(1, 31)) and got[5000] == got[4000] == 0
    assert all(got[1000 + i] == 999 for i in range(50)) and len(got) == 82
    assert components(spark.createDataFrame([], "hi long, lo long")).count() == 0


def near(text, rng):
    words = text.split()
    words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(25):
        text = " ".join(rng.choices(vocabulary, k=400))
        rows += [(len(rows) + j, near(text, rng) if j else text) for j in range(rng.randint(1, 6))]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "One Two"), (904, "one two"), (905, "one two three")]
    rows += [(5, rows[40][1]), (None, rows[30][1]), (None, "alone here and null"), (904, "one two")]
    return rows


def test_near_duplicates_equals_all_pairs(spark, made):
    df = frame(spark, made, [("fp", 3), ("root", "x"), ("row", 1)]).repartition(4)
    got = collected(simhash.near_duplicates(df))
    prints = [(k, plain_print(t)) for k, t in made]
    want = [(k, f"{p:016x}", c) for (k, p), c in zip(prints, plain_components(prints))]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=key) == sorted(want, key=key)


def test_one_per_group(spark, made):
    df = frame(spark, made, [("fp", 3), ("row", 1)])
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    rows = collected(kept)
    prints = [(k, plain_print(t)) for k, t in made]
    # one row per component of prints; the row has the component's smallest id
    root_ids = plain_components([(i, p) for i, (_, p) in enumerate(prints)])
    groups = {}
    for (k, _), r in zip(prints, root_ids):
        groups.setdefault(r, []).append(k)
    want = sorted(str(min((k for k in g if k is not None), default=None)) for g in groups.values())
    assert sorted(str(r["doc_id"]) for r in rows) == want


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    assert simhash.one_per_group(frame(spark, [])).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    prints = [(r.doc_id, plain_print(r.text)) for r in docs.collect()]
    want = {k: (f"{p:016x}", c) for (k, p), c in zip(prints, plain_components(prints))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in collected(simhash.near_duplicates(docs))}
    assert got == want


def test_blocks_are_disjoint_and_cover():
    for path in range(16):
        masks = simhash.blocks_left(path, 2)
        assert len(masks) == 4 and all(bin(m).count("1") == 9 for m in masks)
        assert not any(a & b for i, a in enumerate(masks) for b in masks[:i])
    assert sum(simhash.blocks_left(0, 0)) == (1 << 64) - 1


@pytest.mark.parametrize("hot", [50, 400])
def test_hot_buckets_lose_no_link(spark, monkeypatch, hot):
    """A dense ball of prints round one centre, cut by one to three further shuffles, against all pairs."""
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    rng = random.Random(11)
    centre = rng.getrandbits(64)
    prints = {centre} | {rng.getrandbits(64) for _ in range(200)}
    while len(prints) < 3000:
        p = centre
        for b in rng.sample(range(64), rng.randint(1, 7)):
            p ^= 1 << b
        prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    root = {r.node: r.root for r in simhash.link(df).collect()}
    want = plain_components([(n, p & (1 << 64) - 1) for n, p in enumerate(signed)])
    by_want, by_got = {}, {}
    for n, p in enumerate(signed):
        by_want.setdefault(want[n], set()).add(p)
        by_got.setdefault(root.get(p, p), set()).add(p)
    assert {frozenset(x) for x in by_want.values()} == {frozenset(x) for x in by_got.values()}


def test_large_hot_bucket_is_bounded():
    """Prints of one bucket, met in many batches, are gathered without copying them again and again."""
    import time

    import pyarrow as pa

    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 1 << 62, 200_000)).astype(np.int64)
    batches = [pa.RecordBatch.from_arrays([pa.array(np.full(len(x), 7)), pa.array(x)], names=["key", "fp"]) for x in np.array_split(prints, 400)]
    began = time.process_time()
    assert sum(b.num_rows for b in simhash._compare(3)(iter(batches))) == 0
    assert time.process_time() - began < 60
