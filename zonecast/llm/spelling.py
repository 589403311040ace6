"""Spelling variants: words one edit apart, found through Bloom-guided neighbourhoods.

The vocabulary (distinct words with their counts) is stored once.  A blocked Bloom
filter per word length is built from it and broadcast.  Every word generates its
edits and probes them against the filter of the edit's length; only positives are
shuffled, to an exact join with the vocabulary that removes false positives.

Each pair of near words is generated from one side only: an insertion is the
longer word's deletion, a replacement comes from the word with the smaller letter.
The filters of one pass hold at most ``pass_words`` words (``BITS`` bits each);
a larger vocabulary takes more passes, and a length with more words than that is
split by hash, so what is broadcast does not grow with the vocabulary.

Results in special cases: null, empty and wordless texts give no words; a null id
deletes nothing from its runs; repeated rows count as often as they stand there
(equal ids with different texts are separate rows); an empty table gives no rows;
bytes that are not UTF-8 end a run.  Only the id and the text are read, so other
columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_and_text, ready, slices, stored

RUN = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: bits of filter per word, probed bits per word, bits of a block
BITS, PROBES, BLOCK = 12, 7, 512
#: words of this length and longer share one filter
LONG = 64
PASS_WORDS = 8_000_000
FLUSH_BYTES = 32 << 20
CHUNK = 1 << 20
VOCABULARY = "word string, n long"
NEAR = "word string, n long, near string, near_n long"
# an odd base of the rolling hash and its inverse modulo 2^64
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", thin: int = 31, letters: int = 7, least: int = 2
) -> DataFrame:
    """(word, n): lower-cased letter runs of whole texts, with at least ``letters`` letters and ``least`` occurrences.

    Where the CRC-32 of ``<id>:<run>`` is divisible by ``thin`` (0: never) the run's
    letter at crc modulo length is left out first.  Runs are counted per document
    and then per task, in a table that is emptied at ``FLUSH_BYTES``, so a frequent
    word is a few rows of each task before the shuffle.
    """
    ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        held = 0
        for b in slices(batches):
            for key, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                text = text.as_py().translate(LOWER).decode("utf-8", "replace")
                start = None if key is None or not thin else zlib.crc32(b"%d:" % key)
                for run, times in Counter(RUN.findall(text)).items():
                    if len(run) < letters:
                        continue
                    if start is not None and (h := zlib.crc32(run.encode(), start)) % thin == 0:
                        run = run[:h % len(run)] + run[h % len(run) + 1:]
                        if len(run) < letters:
                            continue
                    before = found.get(run)
                    found[run] = (before or 0) + times
                    if before is None:
                        held += len(run) + 100
                        if held > FLUSH_BYTES:
                            yield from _rows(found)
                            found, held = {}, 0
        yield from _rows(found)

    words = key_and_text(docs, id_col, text_col).mapInArrow(count, VOCABULARY)
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _rows(found: dict[str, int]) -> Iterator[pa.RecordBatch]:
    words = list(found)
    for k in range(0, len(words), 50_000):
        part = words[k:k + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([found[w] for w in part], pa.int64())], names=["word", "n"]
        )


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in ``words``, code points as a matrix) of the words of each length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        rows = max(1, CHUNK // int(size))
        for k in range(0, at.size, rows):
            part = at[k:k + rows]
            text = "".join(words[i] for i in part).encode("utf-32-le")
            yield part, np.frombuffer(text, np.uint32).reshape(part.size, int(size))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Filters:
    """The blocked Bloom filters of one pass: length -> [(part, parts, first block, blocks)]."""

    def __init__(self, shards: list[tuple[int, int, int, int]]):
        self.of: dict[int, list[tuple[int, int, int, int]]] = {}
        self.blocks = 0
        for length, part, parts, words in shards:
            size = max(1, -(-words * BITS // BLOCK))
            self.of.setdefault(length, []).append((part, parts, self.blocks, size))
            self.blocks += size
        self.bits = np.zeros(self.blocks * (BLOCK // 64), np.uint64)

    def places(self, length: int, z: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of hashes ``z`` of words with ``length`` letters: (which, block, hash of the bits)."""
        for part, parts, first, size in self.of.get(min(length, LONG), ()):
            which = np.flatnonzero(z % np.uint64(parts) == part) if parts > 1 else np.arange(z.size)
            block = np.uint64(first) + ((z[which] >> np.uint64(32)) * np.uint64(size) >> np.uint64(32))
            yield which, block, _mixed(z[which])

    @staticmethod
    def bit(block: np.ndarray, h: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
        """The j-th bit of a word: (index in ``bits``, place there)."""
        at = (h >> np.uint64(9 * j)) & np.uint64(BLOCK - 1)
        return (block * np.uint64(BLOCK // 64) + (at >> np.uint64(6))).astype(np.int64), at & np.uint64(63)

    def hold(self, length: int, z: np.ndarray) -> np.ndarray:
        """Indices of the hashes that may be of words in the vocabulary; none of a word is missing."""
        found = []
        for which, block, h in self.places(length, z):
            for j in range(PROBES):
                at, place = self.bit(block, h, j)
                ok = (self.bits[at] >> place & np.uint64(1)).astype(bool)
                which, block, h = which[ok], block[ok], h[ok]
            found.append(which)
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _passes(lengths: dict[int, int], pass_words: int) -> list[list[tuple[int, int, int, int]]]:
    """Shards (length, part, parts, words) in groups of at most about ``pass_words`` words."""
    out, held = [], pass_words
    for length, words in sorted(lengths.items()):
        parts = -(-words // pass_words)
        for part in range(parts):
            size = -(-words // parts)
            if held + size > pass_words:
                out.append([])
                held = 0
            out[-1].append((length, part, parts, size))
            held += size
    return out


def _filled(words: DataFrame, shards: list[tuple[int, int, int, int]]) -> Filters:
    """The filters of one pass, filled by the tasks; the driver gets each 64-bit word of them once."""
    empty = Filters(shards)
    empty.bits = empty.bits[:0]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, bits = [], []
            for _, codes in _by_length(b.column(0).to_pylist()):
                z = _mixed((codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64))
                for _, block, h in empty.places(codes.shape[1], z):
                    for j in range(PROBES):
                        at, place = empty.bit(block, h, j)
                        index.append(at)
                        bits.append(np.uint64(1) << place)
            if not index:
                continue
            index, bits = np.concatenate(index), np.concatenate(bits)
            order = np.argsort(index, kind="stable")
            index, bits = index[order], bits[order]
            first = np.flatnonzero(np.r_[True, index[1:] != index[:-1]]) if index.size else np.zeros(0, np.int64)
            merged = np.bitwise_or.reduceat(bits, first) if first.size else bits
            yield pa.RecordBatch.from_arrays(
                [pa.array(index[first], pa.int64()), pa.array(merged.view(np.int64), pa.int64())], names=["at", "bits"]
            )

    got = words.select("word").mapInArrow(fill, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = got.toArrow()
    filters = Filters(shards)
    filters.bits[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return filters


def _candidates(words: list[str], filters: Filters, alphabet: np.ndarray) -> Iterator[tuple[int, str]]:
    """(position of a word, edit of it that the filters hold): deletions, and replacements by a larger letter."""
    for at, codes in _by_length(words):
        size = codes.shape[1]
        powers = _powers(size)
        terms = codes * powers
        upto = np.cumsum(terms, axis=1, dtype=np.uint64)
        whole = upto[:, -1:]
        if min(size - 1, LONG) in filters.of:
            # letters before stay, letters after move down by one place; of equal letters in a row the first goes
            less = (upto - terms) + (whole - upto) * np.uint64(UNBASE)
            row, i = np.nonzero(np.c_[np.ones(len(codes), bool), codes[:, 1:] != codes[:, :-1]])
            for k in filters.hold(size - 1, _mixed(less[row, i])):
                word = words[at[row[k]]]
                yield at[row[k]], word[:i[k]] + word[i[k] + 1:]
        if min(size, LONG) in filters.of:
            step = max(1, CHUNK // (len(codes) * alphabet.size))
            for lo in range(0, size, step):
                here = codes[:, lo:lo + step, None]
                row, i, letter = np.nonzero(alphabet[None, None, :] > here)
                z = whole[row, 0] + (alphabet[letter] - here[row, i, 0]).astype(np.uint64) * powers[lo + i]
                for k in filters.hold(size, _mixed(z)):
                    word, j = words[at[row[k]]], lo + i[k]
                    yield at[row[k]], word[:j] + chr(alphabet[letter[k]]) + word[j + 1:]


def near_words(words: DataFrame, pass_words: int = PASS_WORDS) -> DataFrame:
    """(word, n, near, near_n): every pair of words of a stored (word, n) table that are one edit apart, both ways round."""
    spark = words.sparkSession
    ready(spark, 8192)
    lengths = words.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("length")).count().collect()
    alphabet = np.asarray(
        sorted(ord(r[0]) for r in words.select(F.explode(F.split("word", "")).alias("c")).filter("c != ''").distinct().collect()),
        np.uint32,
    )
    found = []
    for number, shards in enumerate(_passes({r["length"]: r["count"] for r in lengths}, pass_words)):
        filters = spark.sparkContext.broadcast(_filled(words, shards))

        def probe(batches: Iterator[pa.RecordBatch], filters=filters) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts, counts = b.column(0).to_pylist(), b.column(1).to_pylist()
                rows: list[tuple[int, str]] = []
                held = 0
                for row in _candidates(texts, filters.value, alphabet):
                    rows.append(row)
                    held += len(row[1]) + 50
                    if held > FLUSH_BYTES // 4:
                        yield _edit_rows(rows, texts, counts)
                        rows, held = [], 0
                yield _edit_rows(rows, texts, counts)

        edits = words.select("word", "n").mapInArrow(probe, "word string, n long, near string")
        exact = edits.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
        found.append(stored(exact.select("word", "n", "near", "near_n"), f"near-words-{number}"))
        filters.destroy()
    pairs = spark.createDataFrame([], NEAR)
    for part in found:
        pairs = pairs.unionByName(part)
    swapped = pairs.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    return pairs.unionByName(swapped)


def _edit_rows(rows: list[tuple[int, str]], texts: list[str], counts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([texts[i] for i, _ in rows], pa.string()), pa.array([counts[i] for i, _ in rows], pa.int64()),
            pa.array([edit for _, edit in rows], pa.string()),
        ],
        names=["word", "n", "near"],
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where each word of (word, form) ends when forms are followed; no chain may close to a ring.

    Every round doubles the length of the path that a row has followed.
    """
    links = stored(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        after = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        links = stored(
            links.join(after, "root", "left").select(
                "word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")
            ), "roots",
        )
        if not links.filter("moved").limit(1).count():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 10, **settings) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of a corpus grouped under their usual spelling.

    A word's form is its most frequent near word (ties: the smallest by code points),
    if that is ``ratio`` times as frequent at least; ``root`` follows forms to the
    last (the word itself if it has none).  Counts grow along a chain, so it ends.
    """
    words = stored(vocabulary(docs, id_col, text_col, **settings), "vocabulary")
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near"))).alias("most"),
    )
    usual = F.when(-F.col("most.rank") >= ratio * F.col("n"), F.struct(F.col("most.near"), -F.col("most.rank")))
    formed = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), usual["near"].alias("form"),
            usual["col2"].alias("form_n"),
        ), "formed",
    )
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
