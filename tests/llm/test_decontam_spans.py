import random
import tracemalloc

import numpy as np
import pytest

from zonecast.llm import decontam

from .helpers import collected, frame
from .test_decontam import ITEMS, made, plain_distance  # noqa: F401


def best_span(words, item):
    """(distance, start, words) of the nearest span of any length, the first and shortest of several."""
    return min(
        (plain_distance(words[a:z], item), a, z - a) for a in range(len(words) + 1) for z in range(a, len(words) + 1)
    )


def copies(rng, items, kinds):
    """(item, words) of copies with the full number of allowed edits between foreign words."""
    for i, text in items:
        copy = text.split()
        for _ in range(decontam.allowed(len(copy), 0.2)):
            kind, at = rng.choice(kinds), rng.randrange(len(copy))
            if kind == "lose":
                del copy[at]
            elif kind == "add":
                copy.insert(at, "extra")
            else:
                copy[at] = "zzz"
        before, after = (rng.choices(["x", "y", "z"], k=rng.choice([0, 5, 30])) for _ in range(2))
        yield i, before + copy + after


def test_best_spans_equal_all_spans():
    rng = random.Random(1)
    for _ in range(150):
        m, width = rng.randint(1, 8), rng.randint(1, 12)
        items = np.asarray([[rng.randint(2, 5) for _ in range(m)] for _ in range(3)])
        windows = np.asarray([[rng.randint(1, 5) for _ in range(width)] for _ in range(3)])
        cut = rng.randint(0, width)
        windows[:, cut:] = decontam.FILLER
        for d, start, end, w, i in zip(*decontam.best_spans(windows, items), windows, items):
            assert (d, start, end - start) == best_span(w[:cut].tolist(), i.tolist())


def test_copies_with_lost_or_extra_words(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([10, 17, 25, 40, 55])))) for i in range(40)]
    made = [(i, words) for kinds in (["lose"], ["add"], ["lose", "add", "new"]) for i, words in copies(rng, items, kinds)]
    df = frame(spark, [(n, " ".join(words)) for n, (_, words) in enumerate(made)])
    bench = spark.createDataFrame(items, ITEMS)
    found = {(r["doc_id"], r["item_id"]): r for r in collected(decontam.hits(df, bench))}
    assert sum((n, i) in found for n, (i, _) in enumerate(made)) >= 0.98 * len(made)
    texts = dict(items)
    for (n, i), r in found.items():
        span = made[n][1][r["start_word"]:r["start_word"] + r["n_words"]]
        item = texts[i].split()
        assert plain_distance(span, item) == r["distance"] <= decontam.allowed(len(item), 0.2)
    short = [(n, i) for n, (i, w) in enumerate(made) if len(w) <= 40 and (n, i) in found]
    assert len(short) > 20
    for n, i in short[:20]:
        assert found[n, i]["distance"] == best_span(made[n][1], texts[i].split())[0]
    left = {r["doc_id"] for r in collected(decontam.clean(df, bench))}
    assert not left & {n for n, _ in found}


def test_recall_against_all_spans(spark, made):  # noqa: F811
    docs, items = made
    df = frame(spark, docs).coalesce(1)
    found = {(r["row"], r["item_id"]): r["distance"] for r in collected(decontam.hits(df, spark.createDataFrame(items, ITEMS)))}
    want = {}
    for r, (_, text) in enumerate(docs):
        words = decontam.words_of(text)
        for i, item in items:
            other = decontam.words_of(item)
            # the last row of the free-ended table holds the distance of the best span that ends there
            row = [0] * (len(words) + 1)
            for n, x in enumerate(other, 1):
                last, row[0] = row[0], n
                for j, y in enumerate(words, 1):
                    last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
            if other and words and min(row) <= decontam.allowed(len(other), 0.2):
                want[r, i] = min(min(row), want.get((r, i), 99))
    assert set(found) <= set(want) and len(want) > 50
    assert len(found) >= 0.98 * len(want) and sum(found[x] == want[x] for x in found) >= 0.95 * len(found)


def test_null_item_id(spark):
    item = "one two three four five six seven eight nine ten"
    df = frame(spark, [(1, f"x {item} y"), (2, "nothing of the kind in here at all, not even near")])
    bench = spark.createDataFrame([(None, item), (7, "another passage that no text has at all"), (None, None)], ITEMS)
    rows = [(r["doc_id"], r["item_id"], r["start_word"], r["distance"]) for r in collected(decontam.hits(df, bench))]
    assert rows == [(1, None, 1, 0)]
    assert [r["doc_id"] for r in collected(decontam.clean(df, bench))] == [2]


def edited(rng, words, kinds):
    """A copy with the full number of allowed edits."""
    copy = list(words)
    for _ in range(decontam.allowed(len(words), 0.2)):
        kind, at = rng.choice(kinds), rng.randrange(len(copy))
        if kind == "lose":
            del copy[at]
        elif kind == "add":
            copy.insert(at, "extra")
        else:
            copy[at] = "zzz"
    return copy


def found_in(index, texts):
    get = index.vocabulary.get
    symbols = [np.asarray([get(w.encode(), decontam.OTHER) for w in t], np.int64) for t in texts]
    return {(t, i): (start, n, d) for t, i, start, n, d, _ in decontam.search(index, symbols)}


@pytest.mark.parametrize("size", [59, 100, 150, 200, 250, 300, 400])
@pytest.mark.parametrize("kinds", [["lose"], ["add"], ["lose", "add", "new"]])
def test_recall_on_long_items(size, kinds):
    rng = random.Random(f"{size}{kinds}")
    items = [(i, [f"w{rng.randrange(3000)}" for _ in range(size)]) for i in range(20)]
    index = decontam.build_index([(i, " ".join(w)) for i, w in items])
    texts = [[f"v{rng.randrange(50)}" for _ in range(40)] + edited(rng, w, kinds) + ["end"] * 30 for _, w in items]
    found = found_in(index, texts)
    # every copy carries all of the allowed edits; one in fifty may be missed, of twenty none
    assert set(found) == {(i, i) for i, _ in items}
    for (t, i), (start, n, d) in list(found.items())[:2]:
        assert plain_distance(texts[t][start:start + n], items[i][1]) == d <= decontam.allowed(size, 0.2)
    far = [[f"v{rng.randrange(50)}" for _ in range(40)] + edited(rng, edited(rng, w, ["new"]), ["new"]) for _, w in items]
    assert all(d <= decontam.allowed(size, 0.2) for _, _, d in found_in(index, far).values())


def test_search_without_keys_is_exact():
    """Where sampling cannot reach the recall, every window that the seeds allow is verified."""
    rng = random.Random(3)
    items = [(i, [f"w{rng.randrange(30)}" for _ in range(rng.choice([12, 130]))]) for i in range(6)]
    index = decontam.build_index([(i, " ".join(w)) for i, w in items])
    index.repetitions = dict.fromkeys(index.repetitions, 0)
    texts = [edited(rng, w, ["lose", "add"]) for _, w in items for _ in range(3)]
    found = found_in(index, texts)
    assert {(n, n // 3) for n in range(len(texts))} <= set(found)
    assert decontam.repetitions_for({40: index.by_length[12][1][:, :1].repeat(40, axis=1)}, 0.2, 3, 1, 1.1, 3, 4) == {40: 0}


def test_candidate_windows_equal_spelt_out_seeds():
    rng = random.Random(8)
    for _ in range(60):
        items = [(i, " ".join(f"w{rng.randrange(6)}" for _ in range(rng.choice([1, 3, 9, 20, 130])))) for i in range(4)]
        index = decontam.build_index(items)
        texts = [np.asarray([rng.randrange(1, 8) for _ in range(rng.choice([0, 1, 8, 30]))], np.int64) for _ in range(3)]
        sizes = np.asarray([len(t) for t in texts])
        joined = np.concatenate([x for t in texts for x in (t, [decontam.OTHER])] + [np.zeros(5, np.int64)])
        first = np.cumsum(sizes + 1) - sizes - 1
        got = {m: set(map(tuple, rows.tolist())) for m, rows in decontam.candidate_windows(index, joined, first, sizes).items()}
        want = {}
        for q, (hashes, lengths, places) in index.seeds.items():
            for t, text in enumerate(texts):
                for at in range(len(text) - q + 1):
                    if (text[at:at + q] > decontam.OTHER).all():
                        h = decontam._seed_hashes(text[at:at + q], q)[0]
                        for m, place in zip(lengths[hashes == h].tolist(), places[hashes == h].tolist()):
                            k = decontam.allowed(m, 0.2)
                            room = max(0, len(text) - m + k)
                            want.setdefault(m, set()).update((t, min(max(at - place + x, 0), room)) for x in range(-k, k + 1))
        assert got == want


def test_repeated_seed_takes_bounded_memory():
    """A long text of one seed of a long item, again and again."""
    item = [f"w{n}" for n in range(300)]
    index = decontam.build_index([(0, " ".join(item))])
    text = np.asarray([index.vocabulary[w.encode()] for w in item[:3]] * 40_000, np.int64)
    tracemalloc.start()
    rows = decontam.candidate_windows(index, np.r_[text, decontam.OTHER, np.zeros(500, np.int64)], np.zeros(1, np.int64), np.asarray([len(text)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(len(np.unique(r, axis=0)) == len(r) <= len(text) for r in rows.values()) and peak < 60e6


def test_blocks_are_released(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(20))) for i in range(9)]
    docs = frame(spark, [(i, f"x {t} y") for i, t in items])
    bench = spark.createDataFrame(items, ITEMS)
    one, many = decontam.hits(docs, bench), decontam.hits(docs, bench, items_per_block=2)
    # how often a near span is met depends on the keys' repetitions, which each block measures
    rows = lambda df: sorted(collected(df.drop("n_windows")), key=str)
    assert rows(one) == rows(many)
    # the written blocks are read back: no index stays in the plan
    assert "MapInArrow" not in many._jdf.queryExecution().optimizedPlan().toString()
