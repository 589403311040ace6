import random

import numpy as np
import pytest

from zonecast.llm import decontam

from .helpers import SF, collected, frame

ITEMS = "item_id long, text string"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_hits(docs, items, rate=0.2):
    """Every span, of any length, of every text against every item: (least distance, first start of such a span).

    A row of the table holds, for each place where a span can end, the least (distance, start).
    """
    out = {}
    for r, (_, text) in enumerate(docs):
        words = decontam.words_of(text)
        for i, item in items:
            want = decontam.words_of(item)
            m, k = len(want), int(rate * len(want) + 1e-9)
            if not m or not words:
                continue
            row = [(0, j) for j in range(len(words) + 1)]
            for n, x in enumerate(want, 1):
                last, row[0] = row[0], (n, 0)
                for j, y in enumerate(words, 1):
                    ways = (last[0] + (x != y), last[1]), (row[j][0] + 1, row[j][1]), (row[j - 1][0] + 1, row[j - 1][1])
                    last, row[j] = row[j], min(ways)
            d, s = min(row)
            if d <= k and (d, s) < out.get((r, i), (99, 0)):
                out[r, i] = (d, s)
    return out


def test_words():
    assert decontam.words_of("The CAT,sat-on É!! 3.5\n") == [b"the", b"cat", b"sat", b"on", "é".encode(), b"3", b"5"]
    assert decontam.words_of(None) == [] and decontam.words_of("?! .") == []


def test_edit_distances():
    rng = random.Random(1)
    for _ in range(200):
        m = rng.randint(1, 12)
        items = np.asarray([[rng.randint(2, 5) for _ in range(m)] for _ in range(5)])
        windows = np.asarray([[rng.randint(1, 5) for _ in range(m)] for _ in range(5)])
        cut = rng.randint(0, m)
        windows[:, cut:] = decontam.FILLER
        for got, w, i in zip(decontam.edit_distances(windows, items), windows, items):
            assert got == plain_distance(w[:cut].tolist(), i.tolist())


def test_embedding_keeps_near_sequences_near():
    rng = np.random.default_rng(2)
    base = rng.integers(2, 500, size=(40, 30))
    one = np.stack([decontam._edited(s, 1, rng) for s in base])
    far = rng.integers(2, 500, size=(40, 30))
    k = [decontam.keys(x, 30, 64, 3, 1) for x in (base, one, far)]
    assert (k[0] == k[0]).all() and (k[0] == k[1]).mean() > 0.3 and (k[0] == k[2]).mean() < 0.01


@pytest.fixture(scope="module")
def made():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([4, 9, 15, 22, 40])))) for i in range(12)]
    items += [(50, "solo"), (51, ""), (52, None), (53, items[2][1])]
    docs = []
    for n in range(70):
        words = rng.choices(vocabulary, k=rng.choice([0, 10, 40, 80]))
        _, text = items[n % 12]
        copy = text.split()
        for _ in range(rng.randint(0, max(1, len(copy) // 4))):
            kind, at = rng.randrange(3), rng.randrange(len(copy))
            if kind == 0:
                copy[at] = rng.choice(["zzz", rng.choice(vocabulary)])
            elif kind == 1 and len(copy) > 1:
                del copy[at]
            else:
                copy.insert(at, "extra")
        at = rng.randint(0, len(words))
        docs.append((n, " ".join(words[:at] + copy + words[at:])))
    docs += [(200, None), (200, ""), (None, items[4][1]), (201, items[4][1].upper().replace(" ", ", ")), (202, items[5][1] * 2), (203, "Solo!")]
    return docs, items


def test_recall_against_all_windows(spark, made):
    docs, items = made
    df = frame(spark, docs, [("row", 1), ("item_id", 2)]).coalesce(1)
    got = collected(decontam.hits(df, spark.createDataFrame(items, ITEMS)))
    rows = sorted({r["row"] for r in got})
    want = plain_hits(docs, items)
    assert len(rows) <= len(docs)
    keyed = {(str(docs_id), i): v for (r, i), v in want.items() for docs_id in [docs[r][0]]}
    found = {(str(r["doc_id"]), r["item_id"]): (r["distance"], r["start_word"]) for r in got}
    assert set(found) <= set(keyed)
    assert len(found) >= 0.98 * len(keyed) and len(keyed) > 50
    # the least distance may be missed on a rare window, the pair is what counts
    assert sum(found[x][0] == keyed[x][0] for x in found) >= 0.95 * len(found)
    exact = {x for x, v in keyed.items() if v[0] == 0}
    assert exact <= set(found) and all(found[x][0] == 0 for x in exact)


def test_blocks_give_the_same(spark, made):
    docs, items = made
    df, bench = frame(spark, docs), spark.createDataFrame(items, ITEMS)
    pairs = lambda d: {(r["doc_id"], r["item_id"]) for r in collected(d)}
    a, b = pairs(decontam.hits(df, bench)), pairs(decontam.hits(df, bench, items_per_block=3))
    assert len(a ^ b) <= 2


def test_clean_and_empty(spark, made):
    docs, items = made
    df, bench = frame(spark, docs, [("row", 1), ("whole", 2)]), spark.createDataFrame(items, ITEMS)
    kept = decontam.clean(df, bench)
    assert kept.columns == df.columns
    bad = {docs[r][0] for r, _ in plain_hits(docs, items)}
    left = [r["doc_id"] for r in collected(kept)]
    assert {d for d, _ in docs} - bad <= set(left) and len(set(left) & bad) <= 1
    assert left.count(200) == 2
    assert decontam.hits(frame(spark, []), bench).count() == 0
    assert decontam.hits(df, bench.limit(0)).count() == 0
    assert decontam.clean(df, bench.limit(0)).count() == len(docs)


def test_whole_table(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.filter("length(text) < 6000").collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    found = {(r["doc_id"], r["item_id"]) for r in collected(decontam.hits(docs, bench))}
    # exact passages by plain text search
    for d, t in rows:
        for i, x in items:
            if " ".join(x.lower().split()) in " ".join(t.lower().split()):
                assert (d, i) in found
