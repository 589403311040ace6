"""Benchmark decontamination: edit-distance search through CGK embeddings.

Texts and items are sequences of word symbols.  A document is searched by windows
as long as each item.  The CGK random walk copies a sequence into a string three
times as long, where the number of differing places depends on the edit
distance; sampling a few places gives a key, and repeating walk and sampling
finds a copy within the allowed edits with the target recall (the number of
repetitions is set by edited copies of the items themselves).  A window that
shares a key with an item is widened by the allowed edits on both sides, and the
best span in it, of any length, is found by the exact edit distance.

Only windows at whose start a near span can start are embedded.  k edits leave one
of k + 1 disjoint pieces of the item whole, and move it by at most k places; so a
near span starts within k words of where the first words of some piece put it.
The rule loses nothing; without it every word would start a window of every length.

Items over ``PART_WORDS`` words are searched by equal parts of at most that length, as a
walk drifts apart with the square of the edits.  That loses nothing either: if every part
had more than ``rate`` edits a word, so would the item.  Around a part's candidate the
whole item is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, key_and_text, ready, slices, stored

_HITS = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()),
    ("n_words", pa.int64()), ("distance", pa.int64()), ("n_windows", pa.int64()),
])
_HITS_DDL = "row long, doc_id long, item_id long, start_word long, n_words long, distance long, n_windows long"

#: every byte that is neither an ASCII letter nor digit nor part of a longer character is a blank
_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: symbol numbers: filler behind a sequence's end, a word that no item has
FILLER, OTHER = 0, 1


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words: runs of letters, digits and non-ASCII characters."""
    return (text or "").lower().encode("utf-8", "replace").translate(_WORD_BYTES).split()


def allowed(n_words: int, rate: float) -> int:
    return int(rate * n_words + 1e-9)


# --- embedding -------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sampled_places(length: int, repetitions: int, bits: int, seed: int) -> np.ndarray:
    """Places (repetitions x bits) of the embedded string that a key samples, fixed per item length.

    The pointer moves on at every second step on average, so places from twice
    the length on mostly hold the filler; they are not sampled.
    """
    rng = np.random.default_rng([seed, length])
    return np.sort(rng.integers(0, 2 * length, size=(repetitions, bits)), axis=1)


def keys(symbols: np.ndarray, length: int, repetitions: int, bits: int, seed: int) -> np.ndarray:
    """A key per sequence and repetition, for sequences (rows) of the items' ``length``.

    Row r of a walk: at step j the symbol under the pointer is written out, and
    a random bit of (repetition, step, symbol) moves the pointer on.  Behind the
    end the filler is written.
    """
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros((n, 1), np.uint64)], axis=1)
    width = symbols.shape[1]
    places = sampled_places(length, repetitions, bits, seed)
    rep = (np.arange(repetitions, dtype=np.uint64) + np.uint64(seed * 1_000_003 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    pointer = np.zeros((n, repetitions), np.int64)
    key = np.broadcast_to(_mix(rep + np.uint64(length)), (n, repetitions)).copy()
    rows = np.arange(n)[:, None]
    wanted = [np.flatnonzero((places == j).any(axis=1)) for j in range(2 * length)]
    times = [(places == j).sum(axis=1) for j in range(2 * length)]
    for j in range(int(places.max()) + 1 if places.size else 0):
        symbol = padded[rows, np.minimum(pointer, width)]
        take = wanted[j]
        for _ in range(int(times[j].max()) if len(take) else 0):
            key[:, take] = _mix(key[:, take] * np.uint64(3) + symbol[:, take] + np.uint64(j + 1))
        move = _mix(rep + np.uint64(j * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) + symbol) & np.uint64(1)
        pointer += move.astype(np.int64)
    return key


def edit_distances(windows: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Exact edit distance (insert, delete, replace) of each row pair; filler ends a window."""
    n, m = items.shape
    lengths = (windows != FILLER).sum(axis=1)
    columns = np.arange(windows.shape[1] + 1)
    last = np.broadcast_to(columns, (n, len(columns))).copy()
    for i in range(m):
        here = np.empty_like(last)
        here[:, 0] = i + 1
        here[:, 1:] = np.minimum(last[:, :-1] + (windows != items[:, i:i + 1]), last[:, 1:] + 1)
        # insertions along the row: running minimum of (value - column)
        last = np.minimum.accumulate(here - columns, axis=1) + columns
    return last[np.arange(n), lengths]


def best_spans(windows: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distance, start and end of the span of each window with the least edit distance to its item.

    Both ends are free; of several best spans the first start counts, then the
    first end.  Cells hold distance * scale + start, so one minimum serves both.
    """
    n, m = items.shape
    lengths = (windows != FILLER).sum(axis=1)
    columns = np.arange(windows.shape[1] + 1)
    scale = len(columns)
    last = np.broadcast_to(columns, (n, len(columns))).copy()
    for i in range(m):
        here = np.empty_like(last)
        here[:, 0] = (i + 1) * scale
        here[:, 1:] = np.minimum(last[:, :-1] + scale * (windows != items[:, i:i + 1]), last[:, 1:] + scale)
        last = np.minimum.accumulate(here - scale * columns, axis=1) + scale * columns
    last[columns > lengths[:, None]] = np.iinfo(last.dtype).max
    end = last.argmin(axis=1)
    best = last[np.arange(n), end]
    return best // scale, best % scale, end


# --- index -----------------------------------------------------------------------

#: longer items are searched by parts of at most so many words
PART_WORDS = 120


@dataclass
class Index:
    """Items of one block: vocabulary, and their parts (a short item is one part) with symbols and keys by length."""

    vocabulary: dict[bytes, int]
    rate: float
    #: by part length; 0: sampling does not reach the recall, every window that the seeds allow is verified
    repetitions: dict[int, int]
    bits: int
    seed: int
    #: (id, symbols)
    items: list[tuple[int | None, np.ndarray]]
    #: part length -> ((item, first word) of each part, symbols, sorted keys, part of each key)
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    #: words in a seed -> (sorted seed hashes, part length and place of each)
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


#: kinds of edits: a new word, a loss, an extra word
REPLACE, LOSE, ADD = range(3)


def _edited(symbols: np.ndarray, edits: int, rng: np.random.Generator, kinds: tuple[int, ...] = (REPLACE, LOSE, ADD)) -> np.ndarray:
    """The window of the same length at a copy with so many random edits; foreign words follow a copy that is shorter."""
    s = symbols.tolist()
    for _ in range(edits):
        kind, at = kinds[rng.integers(len(kinds))], int(rng.integers(len(s))) if s else 0
        if kind == REPLACE and s:
            s[at] = OTHER
        elif kind == LOSE and s:
            del s[at]
        else:
            s.insert(at, OTHER)
    return np.asarray((s + [OTHER] * len(symbols))[:len(symbols)], np.int64)


def repetitions_for(
    lengths: dict[int, np.ndarray], rate: float, bits: int, seed: int, recall: float, trials: int = 60, most: int = 256,
) -> dict[int, int]:
    """By length, the repetitions after which edited copies of the items are found with the target recall.

    Copies carry half to all of the allowed edits, of all kinds mixed, only
    losses, or only extra words; the answer is the smallest power of two that
    reaches ``recall`` for each of the three, or 0 if ``most`` does not.
    """
    rng = np.random.default_rng(seed)
    out = {}
    for m, symbols in sorted(lengths.items()):
        k = allowed(m, rate)
        out[m] = 1
        if k == 0:
            continue
        chosen = symbols[rng.integers(0, len(symbols), trials)]
        copies = [
            _edited(s, int(rng.integers(max(1, k // 2), k + 1)), rng, kinds)
            for kinds in ((REPLACE, LOSE, ADD), (LOSE,), (ADD,)) for s in chosen
        ]
        same = keys(np.stack(copies), m, most, bits, seed).reshape(3, trials, most) == keys(chosen, m, most, bits, seed)
        while out[m] < most and same[:, :, :out[m]].any(axis=2).mean(axis=1).min() < recall:
            out[m] *= 2
        if same[:, :, :out[m]].any(axis=2).mean(axis=1).min() < recall:
            out[m] = 0
    return out


#: a seed is at most so many words of a piece
SEED_WORDS = 3


def _seed_hashes(symbols: np.ndarray, q: int) -> np.ndarray:
    h = np.zeros(max(0, len(symbols) - q + 1), np.uint64)
    for j in range(q):
        h = (h + symbols[j:j + len(h)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _seeds(grouped: dict[int, np.ndarray], rate: float) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    found: dict[int, set] = {}
    for m, symbols in grouped.items():
        pieces = allowed(m, rate) + 1
        borders = [m * p // pieces for p in range(pieces + 1)]
        q = min(SEED_WORDS, *(z - a for a, z in zip(borders, borders[1:])))
        for item in symbols:
            for a in borders[:-1]:
                found.setdefault(q, set()).add((int(_seed_hashes(item[a:a + q], q)[0]), m, a))
    out = {}
    for q, rows in found.items():
        rows = sorted(rows)
        out[q] = (np.asarray([r[0] for r in rows], np.uint64), np.asarray([r[1] for r in rows]), np.asarray([r[2] for r in rows]))
    return out


def build_index(
    items: list[tuple[int | None, str | None]], *, rate: float = 0.2, bits: int = 3, seed: int = 1, recall: float = 0.98,
) -> Index:
    """Items without a word are left out (nothing can match them)."""
    split = [(i, words_of(t)) for i, t in items]
    vocabulary: dict[bytes, int] = {}
    for _, words in split:
        for w in words:
            vocabulary.setdefault(w, len(vocabulary) + 2)
    listed = [(i, np.asarray([vocabulary[w] for w in words], np.int64)) for i, words in split if words]
    grouped: dict[int, list] = {}
    for number, (_, item) in enumerate(listed):
        parts = -(-len(item) // PART_WORDS)
        borders = [len(item) * p // parts for p in range(parts + 1)]
        for a, z in zip(borders, borders[1:]):
            grouped.setdefault(z - a, []).append((number, a, item[a:z]))
    symbols = {m: np.stack([x for _, _, x in g]) for m, g in grouped.items()}
    repetitions = repetitions_for(symbols, rate, bits, seed, recall)
    by_length = {}
    for m, g in grouped.items():
        key = keys(symbols[m], m, repetitions[m], bits, seed)
        order = np.argsort(key.ravel(), kind="stable")
        by_length[m] = (
            np.asarray([(number, a) for number, a, _ in g]), symbols[m], key.ravel()[order],
            np.repeat(np.arange(len(g)), repetitions[m])[order],
        )
    return Index(vocabulary, rate, repetitions, bits, seed, listed, by_length, _seeds(symbols, rate))


def _expand(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """low[0], low[0]+1, ... (count[0] of them), then those of low[1], and so on."""
    return np.repeat(low, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


#: seed hits that are looked at together, and cells of a table of distances
SEEDS_AT_ONCE, CELLS = 1 << 20, 1 << 21


def candidate_windows(index: Index, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> dict[int, np.ndarray]:
    """Length -> rows (text, start) of the windows that a seed allows.

    ``symbols`` holds the texts one after the other, each followed by a symbol
    that no item has; ``starts`` and ``sizes`` say where they are.  A seed allows an
    interval of starts; intervals are merged before they are spelt out, so a text
    that repeats a seed has no more rows than places.
    """
    # (text, start) as one number; a start can lie before its text until it is clipped
    shift, zero = np.int64(40), np.int64(1) << np.int64(39)
    found: dict[int, list[np.ndarray]] = {}
    for q, (hashes, lengths, places) in index.seeds.items():
        at = _seed_hashes(symbols, q)
        known = np.ones(len(at), bool)
        for j in range(q):
            known &= symbols[j:j + len(at)] > OTHER
        position = np.flatnonzero(known)
        at = at[position]
        low, high = np.searchsorted(hashes, at, "left"), np.searchsorted(hashes, at, "right")
        hit = np.flatnonzero(high > low)
        count = (high - low)[hit]
        upto, a = np.cumsum(count), 0
        while a < len(hit):
            z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + SEEDS_AT_ONCE, "right")))
            seed = _expand(low[hit[a:z]], count[a:z])
            here = np.repeat(position[hit[a:z]], count[a:z])
            text = np.searchsorted(starts, here, "right") - 1
            begin = (text.astype(np.int64) << shift) + (here - starts[text] - places[seed] + zero)
            for m in np.unique(lengths[seed]):
                kept = found.setdefault(int(m), [])
                kept.append(np.unique(begin[lengths[seed] == m]))
                if sum(map(len, kept)) > 4 * SEEDS_AT_ONCE:
                    kept[:] = [np.unique(np.concatenate(kept))]
            a = z
    out = {}
    for m, kept in found.items():
        code = np.unique(np.concatenate(kept))
        text, begin, k = code >> shift, (code & ((np.int64(1) << shift) - 1)) - zero, allowed(m, index.rate)
        room = np.maximum(0, sizes[text] - m + k)
        low, high = np.clip(begin - k, 0, room), np.clip(begin + k, 0, room)
        again = np.r_[False, text[1:] == text[:-1]]
        low = np.where(again, np.maximum(low, np.r_[0, high[:-1]] + 1), low)
        count = np.maximum(0, high - low + 1)
        out[m] = np.stack([np.repeat(text, count), _expand(low, count)], axis=1)
    return out


def _pairs(index: Index, m: int, joined: np.ndarray, first: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows (window, part) that share a key, or all of them where keys do not reach the recall."""
    owned, _, sorted_keys, owners = index.by_length[m]
    repetitions = index.repetitions[m]
    pairs = [np.zeros((0, 2), np.int64)]
    for a in range(0, len(place), 4096):
        window = _windows(joined, first, sizes, place[a:a + 4096], m)
        if not repetitions:
            row = np.repeat(np.arange(len(window)), len(owned)) + a
            pairs.append(np.stack([row, np.tile(np.arange(len(owned)), len(window))], axis=1))
            continue
        key = keys(window, m, repetitions, index.bits, index.seed).ravel()
        low, high = np.searchsorted(sorted_keys, key, "left"), np.searchsorted(sorted_keys, key, "right")
        hit = np.flatnonzero(high > low)
        if len(hit):
            count = (high - low)[hit]
            row = np.repeat(hit // repetitions, count) + a
            pairs.append(np.unique(np.stack([row, owners[_expand(low[hit], count)]], axis=1), axis=0))
    return np.concatenate(pairs)


def search(index: Index, texts: list[np.ndarray]) -> Iterator[tuple[int, int | None, int, int, int, int]]:
    """(text, item id, start, words, distance, near windows) for each text and item that are near.

    The span with the least distance stands for the pair, of several the first.
    """
    sizes = np.asarray([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return
    longest = max((len(item) for _, item in index.items), default=1)
    gap = np.full(1, OTHER, np.int64)
    joined = np.concatenate([x for t in texts for x in (t, gap)] + [np.zeros(longest + 4 * allowed(longest, index.rate) + 4, np.int64)])
    first = np.cumsum(sizes + 1) - sizes - 1
    best: dict[tuple[int, int], list[int]] = {}
    for m, place in sorted(candidate_windows(index, joined, first, sizes).items()):
        pairs = _pairs(index, m, joined, first, sizes, place)
        owned = index.by_length[m][0]
        item, offset = owned[pairs[:, 1]].T
        whole = np.asarray([len(x) for _, x in index.items], np.int64)[item]
        for size in np.unique(whole):
            k, of = allowed(int(size), index.rate), np.flatnonzero(whole == size)
            text, begin = place[pairs[of, 0]].T
            rows = np.stack([text, item[of], np.maximum(0, begin - offset[of] - k), np.ones(len(of), np.int64)], axis=1)
            width = size + 2 * k
            if size > m:  # parts of one copy start alike: one table of distances for all that start within k words
                rows[:, 2] -= rows[:, 2] % (k + 1)
                rows, n = np.unique(rows, axis=0, return_counts=True)
                rows[:, 3] = n
                width += k
            step = max(1, min(4096, CELLS // int(width)))
            for a in range(0, len(rows), step):
                part = rows[a:a + step]
                targets = np.stack([index.items[i][1] for i in part[:, 1]])
                spans = best_spans(_windows(joined, first, sizes, part[:, ::2], int(width)), targets)
                for j in np.flatnonzero(spans[0] <= k):
                    t, i, start, n = part[j].tolist()
                    span = [int(spans[0][j]), start + int(spans[1][j]), int(spans[2][j] - spans[1][j])]
                    seen = best.setdefault((t, i), [*span, 0])
                    seen[3] += n
                    seen[:3] = min(seen[:3], span)
    for (text, number), (d, start, n_words, n) in sorted(best.items()):
        yield text, index.items[number][0], start, n_words, d, n


def _windows(joined: np.ndarray, first: np.ndarray, sizes: np.ndarray, place: np.ndarray, m: int) -> np.ndarray:
    """The m symbols from each (text, start), filler behind the text's end."""
    text, start = place[:, 0], place[:, 1]
    window = joined[(first[text] + start)[:, None] + np.arange(m)]
    return np.where(start[:, None] + np.arange(m) < sizes[text][:, None], window, FILLER)


def _find(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = index.vocabulary.get
        shortest = min((len(x) - allowed(len(x), index.rate) for _, x in index.items), default=1 << 60)
        for b in slices(batches):
            rows, doc_ids = b.column("row").to_pylist(), b.column("doc_id").to_pylist()
            texts = []
            for text in b.column("text").to_pylist():
                words = words_of(text)
                texts.append(np.asarray([get(w, OTHER) for w in words] if len(words) >= shortest else [], np.int64))
            out: dict[str, list] = {n: [] for n in _HITS.names}
            for t, item, start, n_words, distance, n in search(index, texts):
                for name, v in zip(_HITS.names, (rows[t], doc_ids[t], item, start, n_words, distance, n)):
                    out[name].append(v)
            yield batch(_HITS, out)

    return run


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, items_per_block: int, block_bytes: int):
    """Items in blocks of bounded number and size, in a fixed order; the caller holds at most two of them."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).filter(
        "t is not null"
    ).orderBy("i", "t")
    block, size = [], 0
    for r in rows.toLocalIterator():
        if block and (len(block) >= items_per_block or size + len(r.t) > block_bytes):
            yield block
            block, size = [], 0
        block.append((r.i, r.t))
        size += len(r.t)
    if block:
        yield block


def hits(
    docs: DataFrame, benchmark: DataFrame, *, rate: float = 0.2, recall: float = 0.98, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", items_per_block: int = 20_000,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """One row per row of ``docs`` and item that are near; row is a number for the row of ``docs``.

    row, doc_id, item_id, start_word, n_words (of the nearest span, of any
    length), distance (word edits, at most floor(rate * the item's words)),
    n_windows (item-sized windows that led to a near span).  The items
    are the stated query set: they are searched in blocks of bounded size, each
    a pass over all documents.  Null or wordless texts and items have no rows;
    an item id that repeats with another text, or is null, reports each text's best span;
    repeated rows are reported one by one.  Other columns are ignored; an empty table gives no rows.
    """
    ready(docs.sparkSession)
    rows = key_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    blocks = _blocks(benchmark, item_col, item_text_col, items_per_block, block_bytes)
    found = lambda block: rows.mapInArrow(_find(build_index(block, rate=rate, recall=recall)), _HITS_DDL)
    block, following = next(blocks, None), next(blocks, None)
    if following is None:
        return found(block) if block else rows.sparkSession.createDataFrame([], _HITS_DDL)
    # several blocks: each block's hits are written before the next index is built
    out = stored(found(block), "decontam-hits")
    while following is not None:
        block, following = following, next(blocks, None)
        out = out.unionByName(stored(found(block), "decontam-hits"))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are near no item, with all their columns."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    rows = stored(docs.select(whole, F.monotonically_increasing_id().alias("row")), "decontam-rows")
    texts = rows.select(F.col("row").alias("doc_id"), F.col(f"whole.`{text_col}`").alias("text"))
    found = hits(texts, benchmark, **options)
    bad = stored(found.select(F.col("doc_id").alias("row")).distinct(), "decontam-bad")
    return rows.join(bad, "row", "left_anti").select(*(F.col(f"whole.`{c}`").alias(c) for c in docs.columns))
