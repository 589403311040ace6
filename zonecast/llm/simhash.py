"""SimHash near-duplicate groups found through Golay-code keys.

Fingerprints are computed once per document and reduced to distinct values.  A
distinct value emits about thirty keys (``golay.keys``); values that share a key
are verified by their bit distance in the task that holds the key's bucket, and a
bucket reports a spanning forest of its links, never all its pairs.  Components
come from star rounds over those edges.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import golay
from .common import batch, ready, slices, stored
from .components import components

#: larger buckets are first cut by the pigeonhole rule on four 16-bit blocks
LARGE_BUCKET = 4096
#: buckets with more values go through further shuffles, each cut by four blocks of the bits not yet equal
HOT_BUCKET, CUTS = 1 << 15, 3
_PRINTS = pa.schema([("fp", pa.int64())])
_KEYS = pa.schema([("key", pa.int64()), ("path", pa.int32()), ("fp", pa.int64())])
_EDGES = pa.schema([("hi", pa.int64()), ("lo", pa.int64())])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of UTF-8 ``text``: A-Z lower-cased, words between ASCII blanks."""
    words = text.lower().split()  # on bytes both act on ASCII only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    count, n = np.zeros(64, np.int64), 0
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64)
    for k in range(0, len(hashes), 1 << 15):
        part = hashes[k:k + (1 << 15)].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            prints = np.asarray([fingerprint(t or b"", shingle, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints), *b.columns], names=["fp", *b.schema.names]
            )

    return run


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 1 << 17):
        prints = b.column("fp").to_numpy()
        rows, key = golay.keys(prints.view(np.uint64))
        yield batch(_KEYS, {"key": key.astype(np.int64), "path": np.zeros(len(rows), np.int32), "fp": prints[rows]})


def blocks_left(path: int, cuts: int) -> list[int]:
    """Masks of the four blocks of the bits that ``path`` (a block number of each earlier cut) has not made equal."""
    left = list(range(64))
    for n in range(cuts):
        size, block = len(left) // 4, path >> (2 * n) & 3
        left = left[:block * size] + left[(block + 1) * size:]
    size = len(left) // 4
    return [sum(1 << b for b in left[k * size:(k + 1) * size]) for k in range(4)]


def _cut(cuts: int):
    """Rows of hot buckets, each into the four buckets of one more equal block.

    Two values with at most three differing bits agree on one of any four blocks, so
    every link of a bucket survives in one of its parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1 << 20):
            key, path, prints = (b.column(c).to_numpy() for c in ("key", "path", "fp"))
            out = []
            for p in np.unique(path):
                rows = np.flatnonzero(path == p)
                for n, mask in enumerate(blocks_left(int(p), cuts)):
                    z = (key[rows].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (prints[rows].view(np.uint64) & np.uint64(mask))
                    z = (z ^ (z >> np.uint64(29)) ^ np.uint64(n + 1)) * np.uint64(0xBF58476D1CE4E5B9)
                    z ^= z >> np.uint64(32)  # buckets whose numbers collide are compared together: no link is lost or made
                    out.append((z.view(np.int64), np.full(len(rows), int(p) | n << (2 * cuts), np.int32), prints[rows]))
            if out:
                yield batch(_KEYS, {name: np.concatenate(x) for name, x in zip(_KEYS.names, zip(*out))})

    return run


def _forest(prints: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Star edges (members, smallest member) of the linked groups among sorted distinct ``prints``."""
    edges = []
    rest = prints
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        frontier, found = [root], []
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= most
            if near.any():
                found.append(rest[near])
                frontier.extend(rest[near])
                rest = rest[~near]
        if found:
            members = np.concatenate(found)
            edges.append((members, np.full(len(members), root)))
    return edges


def bucket_edges(prints: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that join all prints of one bucket which links of at most ``most`` bits connect."""
    if len(prints) <= LARGE_BUCKET or most >= 4:
        return _forest(prints, most)
    edges = []
    for low in (0, 16, 32, 48):  # at most three differing bits leave one of four blocks equal
        block = (prints >> np.uint64(low)) & np.uint64(0xFFFF)
        order = np.argsort(block, kind="stable")
        ends = np.flatnonzero(np.diff(block[order])) + 1
        for part in np.split(prints[order], ends):
            if len(part) > 1:
                edges += _forest(part, most)
    return edges


def _links(key: np.ndarray, prints: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of whole buckets; rows are sorted by key and print."""
    if not len(key):
        return []
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (prints[1:] != prints[:-1])
    key, prints = key[fresh], prints[fresh]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([first, [len(key)]]))
    out = []
    of_row = np.repeat(size, size)
    for gap in range(1, 8):  # buckets of at most eight: all comparisons at once
        near = (key[gap:] == key[:-gap]) & (of_row[gap:] <= 8)
        near &= np.bitwise_count(prints[gap:] ^ prints[:-gap]) <= most
        if near.any():
            out.append((prints[gap:][near], prints[:-gap][near]))
    for start, n in zip(first[size > 8], size[size > 8]):
        out += bucket_edges(prints[start:start + n], most)
    return out


def _compare(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = [], []  # pieces of the rows not compared yet; all of one bucket but for the last

        def rows(links):
            if links:
                ends = np.stack([np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links])], axis=1)
                # smaller and larger end as signed numbers, as Spark orders them
                ends = np.unique(np.sort(ends.view(np.int64), axis=1), axis=0)
                yield batch(_EDGES, {"hi": ends[:, 1], "lo": ends[:, 0]})

        for b in batches:
            key, prints = b.column("key").to_numpy(), b.column("fp").to_numpy().view(np.uint64)
            if not len(key):
                continue
            held_key.append(key)
            held.append(prints)
            if key[-1] == held_key[0][0]:
                continue  # still the first bucket: nothing is copied
            key, prints = np.concatenate(held_key), np.concatenate(held)
            whole = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
            yield from rows(_links(key[:whole], prints[:whole], most))
            held_key, held = [key[whole:]], [prints[whole:]]
        if held:
            yield from rows(_links(np.concatenate(held_key), np.concatenate(held), most))

    return run


def link(prints: DataFrame, most: int = 3) -> DataFrame:
    """(node, root) of every long in column ``fp`` (distinct) whose component has a smaller member.

    Links are at most ``most`` (0 to 3) differing bits; null is not expected.
    """
    if not 0 <= most <= 3:
        raise ValueError("the segments' pigeonhole rule holds up to 3 bits")
    shape = "key long, path int, fp long"
    rows, edges = prints.select("fp").mapInArrow(_emit_keys, shape), []

    def compared(part: DataFrame) -> DataFrame:
        buckets = part.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
        return buckets.mapInArrow(_compare(most), "hi long, lo long")

    for cuts in range(CUTS):
        # counts are pre-aggregated; usually no bucket is hot and the rows are compared as they are
        sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_BUCKET)
        hot = stored(sizes.select("key"), "simhash-hot")
        if not hot.limit(1).count():
            break
        rows = stored(rows.join(hot.withColumn("hot", F.lit(True)), "key", "left"), "simhash-buckets")
        edges.append(stored(compared(rows.filter("hot is null")), "simhash-links"))
        rows = rows.filter("hot").select("key", "path", "fp").mapInArrow(_cut(cuts), shape)
    links = compared(rows)
    for part in edges:
        links = links.unionByName(part)
    return components(links)


def near_duplicates(
    docs: DataFrame, *, shingle: int = 3, most: int = 3, seed: int = 42, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id that links of at most ``most`` bits reach,
    the row's own included; null only where a whole component has null ids.
    Null, empty and blank texts have fingerprint zero and link like any other.
    Repeated rows and ids keep one row each.  Other columns are ignored; an empty
    table gives no rows.
    """
    rows, ids = _grouped(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                         shingle, most, seed)
    # stored between the joins: then both sides of each come straight from an exchange, and the
    # skew-join rule may split a component or a print that holds many rows
    component = stored(ids.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-components")
    by_print = stored(ids.join(component, "root").select("fp", "component_id"), "simhash-by-print")
    return rows.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _grouped(rows: DataFrame, shingle: int, most: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Stored rows with ``fp``, and per distinct print its smallest id and its component's root."""
    ready(rows.sparkSession)
    shape = StructType([StructField("fp", LongType()), *rows.schema.fields])
    printed = rows.mapInArrow(_fingerprints(shingle, seed), shape)
    printed = stored(printed.drop("text"), "simhash-prints")
    classes = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    labels = link(classes, most)
    ids = classes.join(labels, classes.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    return printed, stored(ids, "simhash-roots")


def one_per_group(
    docs: DataFrame, *, shingle: int = 3, most: int = 3, seed: int = 42, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Of every near-duplicate group the row with the smallest id, all columns of ``docs``.

    Among equal ids (nulls come after all ids) the first stored row stays.  Edge
    cases otherwise as in ``near_duplicates``.
    """
    inner = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"),
    ).withColumn("row", F.monotonically_increasing_id())
    rows, ids = _grouped(inner, shingle, most, seed)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    by_root = rows.select("fp", "doc_id", "row").groupBy("fp").agg(first.alias("f"))
    kept = (
        by_root.join(ids.select("fp", "root"), "fp").groupBy("root").agg(F.min("f").alias("f"))
        .select(F.col("f.row").alias("row"))
    )
    return rows.join(kept, "row", "left_semi").select(*(F.col(f"whole.`{c}`").alias(c) for c in docs.columns))

