"""Size-balanced shards by sampled splitters, in DataFrame functions only.

Rows are ordered by (hash of the text, row number), so equal texts stand together.
A size-weighted sample of that key gives quantile boundaries for many small
ranges; ranges that come out overfull (one text on very many rows) are subdivided
by the row number.  Exact totals per range, prefix sums over the ranges and a
running sum inside each range give every row its position in the byte stream,
which is cut into equal shards.  Only keys and sizes move; a window never holds
more than about two ranges' rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, with_offsets

LAW = "bytes"
SHARDS = 40
#: what a record costs besides its text, in bytes
RECORD_BYTES = 16
#: weighted sample keys drawn per range
SAMPLE_PER_RANGE = 20


def text_size(text_col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + RECORD_BYTES


def _uniform(row: Column, seed: int) -> Column:
    """A fixed number in [0, 1) for each row number."""
    return F.pmod(F.xxhash64(row, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def splitters(rows: DataFrame, ranges: int, n: int, total_size: int, seed: int = 11) -> list[int]:
    """At most ``ranges - 1`` ascending key boundaries with about equal weight between them.

    A row's weight is half its share of all bytes and half its share of all
    rows, so that many tiny rows of one key show up as well.  A row enters the
    sample with probability proportional to its weight: about
    ``SAMPLE_PER_RANGE * ranges`` keys come to the driver, whatever the row count.
    A key with more than a range's share is a boundary itself.
    """
    wanted = SAMPLE_PER_RANGE * ranges
    chance = F.col("size") * F.lit(wanted / 2 / max(1, total_size)) + F.lit(wanted / 2 / max(1, n))
    sample = [r.key for r in rows.filter(_uniform(F.col("row"), seed) < chance).select("key").collect()]
    sample.sort()
    if not sample:
        return []
    cuts = {sample[len(sample) * i // ranges] for i in range(1, ranges)}
    return sorted(cuts)


def range_of(key: Column, boundaries: list[int]) -> Column:
    """Number of boundaries not above ``key``, by binary search over a constant array."""
    if not boundaries:
        return F.lit(0)
    table = F.lit(np.asarray(boundaries, np.int64))
    steps = [1 << b for b in reversed(range(len(boundaries).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(table, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at),
    )


@dataclass
class Plan:
    """Ranges, the pieces of overfull ones, and the totals."""

    boundaries: list[int]
    pieces: list[int]
    rows: int
    size: int

    def place(self, rows: DataFrame) -> DataFrame:
        """Adds rng and piece: the small ranges in which rows are ordered."""
        ranged = rows.withColumn("rng", range_of(F.col("key"), self.boundaries))
        if max(self.pieces, default=1) == 1:
            return ranged.withColumn("piece", F.lit(0))
        count = F.get(F.lit(np.asarray(self.pieces, np.int32)), F.col("rng"))
        # a range starts at its boundary: that key's rows are dealt out, the rest follow as the last piece
        start = F.get(F.lit(np.asarray(self.boundaries, np.int64)), F.col("rng") - 1)
        dealt = F.pmod(F.xxhash64("row", F.lit(3)), count)
        return ranged.withColumn("piece", F.when(
            (count > 1) & (F.col("key") == start), dealt
        ).when(count > 1, count).otherwise(0).cast("int"))


def plan(rows: DataFrame, shards: int = SHARDS, rows_per_range: int = 200_000) -> Plan:
    """Splitters and subdivisions for rows with columns key, row and size.

    The number of ranges, and with it the sample, grows with the row count.
    """
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    ranges = max(2 * shards, -(-total.n // rows_per_range))
    boundaries = splitters(rows, ranges, total.n, total.size)
    found = (
        rows.groupBy(range_of(F.col("key"), boundaries).alias("rng"))
        .agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    )  # one row per range
    fair_rows, fair_size = max(1, total.n / ranges), max(1, total.size / ranges)
    pieces = [1] * (len(boundaries) + 1)
    for r in found:
        over = max(r.n / fair_rows, r.size / fair_size)
        if over > 2:
            pieces[r.rng] = int(-(-over // 1))
    return Plan(boundaries, pieces, total.n, total.size)


def place_rows(rows: DataFrame, shards: int = SHARDS, rows_per_range: int = 200_000) -> DataFrame:
    """Adds shard and slot to stored rows with columns key, row and size."""
    p = plan(rows, shards, rows_per_range)
    ranged = p.place(rows)
    totals = ranged.groupBy("rng", "piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    offsets = with_offsets(totals, ["rng", "piece"], ["bytes", "n"])
    inside = Window.partitionBy("rng", "piece").orderBy("key", "row")
    running = ranged.withColumn("upto", F.sum("size").over(inside)).withColumn("nth", F.row_number().over(inside))
    # a row per range: bounded by rows / rows_per_range
    placed = running.join(F.broadcast(offsets.select("rng", "piece", "bytes_before", "n_before")), ["rng", "piece"])
    middle = 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")  # twice the middle of the row's bytes
    shard = F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(2.0 * max(1, p.size))).cast("int"))
    placed = stored(
        placed.withColumn("shard", shard).withColumn("position", F.col("n_before") + F.col("nth") - 1)
        .drop("rng", "piece", "upto", "nth", "bytes_before", "n_before"), "shard-rows",
    )
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("position") - F.col("first")).drop(
        "position", "first"
    )


def assign(
    docs: DataFrame, shards: int = SHARDS, *, rows_per_range: int = 200_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: law is bytes).

    Shard sizes differ by no more than about one document's size.  Equal texts
    (null and empty text count as equal) follow each other, in one shard unless a
    cut falls between them; repeated rows are placed one by one.  Null ids are
    kept.  Slots count from 0 in every shard; with fewer documents than shards
    some shards stay empty.  Other columns are ignored; an empty table gives no
    rows.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).select(
        "doc_id", text_size("text").alias("size"), F.crc32("text").alias("text_crc32"),
        F.xxhash64("text").alias("key"), F.monotonically_increasing_id().alias("row"),
    )
    placed = place_rows(stored(rows, "shard-keys"), shards, rows_per_range)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, *, rows_per_range: int = 200_000, text_col: str = "text",
    rows_per_file: int = 1_000_000,
) -> DataFrame:
    """Write the rows of ``docs`` as Parquet under ``path``/shard=N/, and return them with shard and slot.

    The rows are the struct column ``whole``, so no column of theirs can clash.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    rows = stored(docs.select(
        whole, text_size(text_col).alias("size"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    ), "shard-whole")
    where = place_rows(rows.drop("whole"), shards, rows_per_range).select("row", "shard", "slot")
    (
        rows.select("row", "whole").join(where, "row")
        .repartition("shard", F.floor(F.col("slot") / rows_per_file)).sortWithinPartitions("shard", "slot")
        .select("shard", "slot", "whole").write.partitionBy("shard").parquet(path)
    )
    return docs.sparkSession.read.parquet(path)

