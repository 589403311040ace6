"""Data-quality contracts (D4): declared rules, counted by one observed aggregate, failing rows set apart with reasons.

A rule names the condition that *fails* a row; a condition that is null does not fail.
Counting costs no pass of its own: the counts are observed while the rows flow to their
sink (``observed``), or come from one aggregate (``counts``).  Quarantine keeps every
failing row whole, with the names of all rules it breaks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .quality import evaluate_once

REASONS = "failed_rules"


@dataclass(frozen=True)
class Rule:
    """A named condition, in SQL, of the rows that break it."""

    name: str
    fails: str

    def column(self) -> Column:
        return F.coalesce(F.expr(self.fails), F.lit(False))


#: rules for decoded trip events: presence, sign, and sanity of the times
TRIP_CONTRACT = (
    Rule("pickup time missing", "pickup_datetime is null"),
    Rule("dropoff time missing", "dropoff_datetime is null"),
    Rule("dropoff before pickup", "dropoff_datetime < pickup_datetime"),
    Rule("longer than a day", "dropoff_datetime > pickup_datetime + interval 1 day"),
    Rule("arrival time missing", "emitted_at is null"),
    Rule("arrival before pickup", "emitted_at < pickup_datetime"),
    Rule("distance missing", "trip_distance is null"),
    Rule("distance negative", "trip_distance < 0"),
    Rule("amount missing", "total_amount is null"),
    Rule("amount negative", "total_amount < 0"),
    Rule("passengers missing", "passenger_count is null"),
    Rule("passengers negative", "passenger_count < 0"),
    Rule("pickup zone invalid", "pu_location_id is null or pu_location_id <= 0"),
    Rule("dropoff zone invalid", "do_location_id is null or do_location_id <= 0"),
)


class Contract:
    def __init__(self, rules: tuple[Rule, ...] = TRIP_CONTRACT):
        if len({r.name for r in rules}) < len(rules):
            raise ValueError("two rules have one name")
        self.rules = rules

    def marked(self, df: DataFrame) -> DataFrame:
        """``df`` with the names of the rules that a row breaks, in declared order; an empty list for a good row."""
        names = F.array(*(F.when(r.column(), F.lit(r.name)) for r in self.rules))
        # the columns that the rules test, and the list itself, are computed once per row
        return evaluate_once(evaluate_once(df).withColumn(REASONS, F.filter(names, lambda n: n.isNotNull())))

    def _aggregates(self) -> list[Column]:
        broken = lambda n: F.count_if(F.array_contains(REASONS, self.rules[n].name)).alias(f"rule_{n}")
        return [F.count("*").alias("rows"), F.count_if(F.size(REASONS) > 0).alias("failed"), *map(broken, range(len(self.rules)))]

    def observed(self, df: DataFrame, name: str | Observation) -> DataFrame:
        """The marked rows; their counts arrive as the observed metric ``name`` when they have flowed through."""
        return self.marked(df).observe(name, *self._aggregates())

    def counts(self, df: DataFrame) -> DataFrame:
        """(rule, rows, failed) from one aggregate over ``df``."""
        one = self.marked(df).agg(*self._aggregates())
        return self._long(one)

    def counts_of(self, spark: SparkSession, metrics: dict[str, int]) -> DataFrame:
        """The same table from an observed metric (``Observation.get``)."""
        return self._long(spark.createDataFrame([tuple(metrics.values())], ", ".join(f"{k} long" for k in metrics)))

    def _long(self, one: DataFrame) -> DataFrame:
        each = [F.struct(F.lit("any rule").alias("rule"), F.col("failed").alias("failed"))]
        each += [F.struct(F.lit(r.name).alias("rule"), F.col(f"rule_{n}").alias("failed")) for n, r in enumerate(self.rules)]
        return one.select("rows", F.explode(F.array(*each)).alias("x")).select("x.rule", "rows", "x.failed")


def good(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size(REASONS) == 0).drop(REASONS)


def quarantined(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size(REASONS) > 0)


def run_contract_stream(rows: DataFrame, contract: Contract, good_path: str, quarantine_path: str, checkpoint: str, trigger: dict | None = None):
    """Stream ``rows`` through the contract into two tables, and return one dict of counts per micro-batch.

    Each batch lies under its number in both tables, so a batch that is repeated after a
    failure replaces itself; counts are observed during the write of the quarantine.
    """
    seen: dict[int, dict[str, int]] = {}

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            counted = Observation(f"contract-{batch_id}")
            marked = contract.observed(batch, counted)
            quarantined(marked).write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
            good(contract.marked(batch)).write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            seen[batch_id] = counted.get
        finally:
            batch.unpersist()

    q = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    q.awaitTermination()
    return seen
