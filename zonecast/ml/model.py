"""Boosted-tree tip model on Spark MLlib.

Continued boosting is expressed as residual stages: stage 1 fits
``GBTRegressor(maxIter=init_trees)`` on the first chronological batch; stage k
fits ``maxIter=trees_per_batch`` trees on batch k's residual y - F(x), where F
is the sum of the previous stages.  After each stage the validation MAE is
measured and the best prefix of stages is kept (strictly better MAE needed).
The stage loop is a driver loop of Spark jobs (an iterative algorithm); every
batch and scored frame is a distributed DataFrame.
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.aggregate import mae_mape
from ..operators.select import batch_index
from ..session import materialize, scratch_path
from ..sinks.tables import delete_path

PRED = "prediction"
#: rows of a batch in one partition: a tree is a chain of short jobs, each as dear as its tasks are many
SLICE_ROWS = 32_768
#: batches whose margins are stored together, and whose stages are validated together
GROUP_BATCHES = 8
#: stages written or read at a time
MODEL_THREADS = 8
#: one of this many cores works ahead on margins and validation while trees are fitted
ASIDE_SHARE = 3


def ensure_features(df: DataFrame, features: list[str] = S.TIP_FEATURES) -> DataFrame:
    """M2: a missing feature column is added as 0."""
    out = df
    for c in features:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(0.0))
    return out


def assemble(df: DataFrame, features: list[str] = S.TIP_FEATURES, out: str = "features") -> DataFrame:
    """M1: feature vector (nulls kept as NaN; trees route them).  Feature
    columns keep their own types; the assembler reads any numeric type."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(
        ensure_features(df, features)
    )


def gbt(max_iter: int, label: str) -> GBTRegressor:
    """M4: depth 5, step 0.05, row sample 0.9, feature sample 0.9, squared loss, seed 42."""
    return GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol=PRED,
        maxIter=max_iter,
        maxDepth=S.GBT_MAX_DEPTH,
        stepSize=S.GBT_STEP,
        subsamplingRate=S.GBT_SUBSAMPLE,
        featureSubsetStrategy=S.GBT_FEATURE_SUBSET,
        lossType="squared",
        seed=S.GBT_SEED,
    )


@dataclass
class StagedModel:
    """Sum of residual GBT stages."""

    stages: list[GBTRegressionModel]
    features: list[str] = field(default_factory=lambda: list(S.TIP_FEATURES))
    trained_at: str = ""
    training_rows: int = 0

    def predict(self, df: DataFrame, out: str = "tip_pred") -> DataFrame:
        """Add ``out`` = F(x); input needs the feature columns (missing -> 0)."""
        cur = assemble(df, self.features)
        total: Column = F.lit(0.0)
        for i, m in enumerate(self.stages):
            col = f"__stage{i}"
            cur = m.copy({m.predictionCol: col}).transform(cur)
            total = total + F.col(col)
        cur = cur.withColumn(out, total)
        return cur.drop("features", *[f"__stage{i}" for i in range(len(self.stages))])


def mae_mape_frame(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """A6/A7 as a one-row frame (mae, mape)."""
    return df.agg(*mae_mape(truth, pred))


class NotEnoughData(ValueError):
    """A split is smaller than training needs."""


def check_sizes(sizes: dict[str, int]) -> None:
    """W10 guards: raise unless every split of ``sizes`` (train, test, core, val) is large enough."""
    least = {"train": S.MIN_TRAIN_ROWS, "test": S.MIN_TEST_ROWS, "core": S.MIN_CORE_ROWS, "val": S.MIN_VAL_ROWS}
    short = {k: sizes.get(k, 0) for k, n in least.items() if k in sizes and sizes[k] < n}
    if short:
        raise NotEnoughData("not enough rows: " + ", ".join(f"{n} {k} (at least {least[k]})" for k, n in short.items()))


def split_counts(positioned: DataFrame) -> dict[str, int]:
    """Rows of the train and test split and of the core and validation part."""
    r = positioned.agg(
        F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test"),
        F.count_if(F.col("part") == "core").alias("core"), F.count_if(F.col("part") == "val").alias("val"),
    ).first()
    return r.asDict()


def add_margin(df: DataFrame, stages: list[GBTRegressionModel], margin: str = "__f") -> DataFrame:
    """Add the shares of ``stages`` to ``margin``, one after the other, as ``StagedModel.predict`` does."""
    for m in stages:
        scored = m.copy({m.predictionCol: "__share"}).transform(df)
        df = scored.withColumn(margin, F.col(margin) + F.col("__share")).drop("__share")
    return df


def training_slices(batch: DataFrame, first: int, rows: int) -> DataFrame:
    """A batch of ``rows`` positions from ``first`` on, ``SLICE_ROWS`` of them to a partition, in their order.

    The partitions depend on the batch alone, not on those of the whole input, whose
    number grows with it, and so do the rows that the trees sample.
    """
    part = F.floor((F.col("rn") - F.lit(first)) / F.lit(SLICE_ROWS)).cast("int")
    return batch.repartitionById(math.ceil(rows / SLICE_ROWS), part).sortWithinPartitions("rn")


def train_staged(
    core: DataFrame,
    val: DataFrame,
    rows_per_batch: int = S.TRAIN_BATCH_ROWS,
    init_trees: int = S.INIT_TREES,
    trees_per_batch: int = S.TREES_PER_BATCH,
    target: str = S.TARGET,
) -> tuple[StagedModel, list[dict]]:
    """M5: chronological residual stages; returns the best prefix and the history.

    ``core`` must carry ``rn`` (global position); batches are
    floor((rn - first_rn) / rows_per_batch).  Its rows are stored by groups of
    ``GROUP_BATCHES`` batches, so that each is read for its own group only.  Trees are
    fitted one after the other by short jobs that leave most cores idle; meanwhile a second
    thread, on a part of the cores, stores the next group's rows with the margin of the
    groups already fitted, and adds these groups' shares to the validation rows, which
    gives the errors after each stage.  So a batch itself waits for the stages of its own
    group and the one before only, however many there are.
    """
    spark = core.sparkSession
    bounds = core.agg(F.min("rn").alias("first"), F.max("rn").alias("last"), F.count(F.lit(1)).alias("n")).first()
    check_sizes({"core": bounds.n})
    store = scratch_path(spark, "batches")
    batched = assemble(core).withColumn("__batch", batch_index(F.col("rn") - F.lit(bounds.first) + 1, rows_per_batch))
    grouped = batched.select("rn", target, "features", "__batch", F.floor(F.col("__batch") / F.lit(GROUP_BATCHES)).alias("__group"))
    grouped.write.partitionBy("__group").parquet(store)
    rows = spark.read.parquet(store)
    sizes = {r["__batch"]: r["count"] for r in rows.groupBy("__batch").count().collect()}
    running = materialize(assemble(val).select(target, "features", F.lit(0.0).alias("__f")))
    stages: list[GBTRegressionModel] = []
    history: list[dict] = []
    groups = sorted({b // GROUP_BATCHES for b in sizes})
    lanes = max(1, spark.sparkContext.defaultParallelism // ASIDE_SHARE)

    def ahead(g: int, known: list[GBTRegressionModel]) -> DataFrame:
        out = rows.filter(F.col("__group") == g).withColumn("__f", F.lit(0.0)).coalesce(lanes)
        for i in range(0, max(len(known), 1), GROUP_BATCHES):  # a few stages a pass: one plan of many is far slower a stage
            out = materialize(add_margin(out, known[i : i + GROUP_BATCHES]))
        return out

    def validate(first: int, end: int) -> None:
        nonlocal running
        running = _validate(running.coalesce(lanes), stages[first:end], history[first:end], target)

    group, known, checked = materialize(rows.filter(F.col("__group") == groups[0]).withColumn("__f", F.lit(0.0))), 0, 0
    with ThreadPoolExecutor(1) as aside:
        for g, following in zip(groups, [*groups[1:], None], strict=True):
            done = len(stages)
            waiting = [] if following is None else [aside.submit(ahead, following, stages[:done])]
            if checked < done:
                waiting.append(aside.submit(validate, checked, done))
                checked = done
            for b in sorted(b for b in sizes if b // GROUP_BATCHES == g):
                first = bounds.first + b * rows_per_batch
                batch = training_slices(group.filter(F.col("__batch") == b), first, min(rows_per_batch, bounds.last - first + 1))
                if stages:
                    label, n_trees = F.col(target) - F.col("__f"), trees_per_batch
                else:
                    label, n_trees = F.col(target), init_trees
                labelled = add_margin(batch, stages[known:]).select("features", label.alias("__label"))
                stages.append(gbt(n_trees, "__label").fit(materialize(labelled)))
                history.append({"batch": len(stages), "rows": sizes[b], "trees": n_trees})
            results = [w.result() for w in waiting]
            if following is not None:
                group, known = results[0], done
    _validate(running, stages[checked:], history[checked:], target)
    delete_path(spark, store)
    best_mae, best_k = float("inf"), len(stages)
    for entry in history:
        if entry["val_mae"] < best_mae:
            best_mae, best_k = entry["val_mae"], entry["batch"]
    return StagedModel(stages[:best_k]), history


def _validate(running: DataFrame, stages: list[GBTRegressionModel], history: list[dict], target: str) -> DataFrame:
    """The validation rows with ``stages`` added to their margin; each stage's errors go into its entry of ``history``."""
    after = [f"__f{i}" for i in range(len(stages))]
    for name, stage in zip(after, stages, strict=True):
        running = add_margin(running, [stage]).withColumn(name, F.col("__f"))
    running = materialize(running)
    pairs = [(mae.alias(f"mae{i}"), mape.alias(f"mape{i}")) for i, (mae, mape) in enumerate(mae_mape(target, c) for c in after)]
    errors = running.agg(*(c for pair in pairs for c in pair)).first()
    for i, entry in enumerate(history):
        if errors[f"mae{i}"] is None:
            raise NotEnoughData("no validation rows")
        entry |= {"val_mae": float(errors[f"mae{i}"]), "val_mape": float(errors[f"mape{i}"])}
    return running.drop(*after)


def metrics_row(scored: DataFrame, target: str = S.TARGET) -> DataFrame:
    """M6 in one pass: errors of ``tip_pred`` by split and part and of ``baseline_pred`` on the test split."""
    def where(condition):
        return scored_errors("tip_pred", condition)

    def scored_errors(pred, condition):
        err = F.abs(F.col(target) - F.col(pred))
        denom = F.when(F.col(target) == 0, F.lit(S.MAPE_ZERO_TRUTH)).otherwise(F.col(target))
        return F.avg(F.when(condition, err)), F.avg(F.when(condition, err / denom)) * F.lit(100.0)

    train, test, val = F.col("split") == "train", F.col("split") == "test", F.col("part") == "val"
    out = [F.count_if(train).alias("training_rows"), F.count_if(test).alias("testing_rows"),
           F.to_date(F.min(F.when(test, F.col("window_start")))).alias("test_period_start")]
    for name, (mae, mape) in {
        "baseline": scored_errors("baseline_pred", test), "train": where(train), "val": where(val), "test": where(test),
    }.items():
        out += [mae.alias(f"{name}_mae"), mape.alias(f"{name}_mape")]
    return scored.agg(*out)


def metrics_document(metrics: dict, history: list[dict], batch_rows: int, init_trees: int, trees_per_batch: int, generated_at: str) -> dict:
    """K6: the metrics document (errors 4 dp, percentages 2 dp) with the batch history."""
    pair = lambda name: {"mae": round(metrics[f"{name}_mae"], 4), "mape": round(metrics[f"{name}_mape"], 2)}
    best = min(history, key=lambda h: (h["val_mae"], h["batch"]))
    return {
        "generated_at": generated_at,
        "training_rows": metrics["training_rows"],
        "testing_rows": metrics["testing_rows"],
        "test_period_start": str(metrics["test_period_start"]),
        "target": S.TARGET,
        "baseline": pair("baseline"),
        "model": {
            "train": pair("train"), "validation": pair("val"), "test": pair("test"),
            "continued_training": {
                "batch_rows": batch_rows, "init_trees": init_trees, "trees_per_batch": trees_per_batch,
                "selected_best_batch": best["batch"], "selected_best_val_mae": round(best["val_mae"], 4),
                "history": [{"batch": h["batch"], "val_mae": round(h["val_mae"], 4), "val_mape": round(h["val_mape"], 2)} for h in history],
            },
        },
        "improvement_mae": round(metrics["baseline_mae"] - metrics["test_mae"], 4),
    }


# ---------------------------------------------------------------------------
# K7: save / load
# ---------------------------------------------------------------------------


def save_model(spark: SparkSession, model: StagedModel, path: str, history: list[dict] | None = None) -> None:
    """K7: stages first, the description last: a model without one is not complete."""
    with ThreadPoolExecutor(MODEL_THREADS) as pool:  # small jobs, each of which leaves most cores idle
        list(pool.map(lambda i: model.stages[i].write().overwrite().save(f"{path}/stage_{i:03d}"), range(len(model.stages))))
    meta = {
        "features": model.features,
        "trained_at": model.trained_at,
        "training_rows": model.training_rows,
        "stages": len(model.stages),
        "target": S.TARGET,
        "history": history or [],
    }
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
        f"{path}/meta"
    )


def load_history(spark: SparkSession, path: str) -> list[dict]:
    return json.loads(spark.read.text(f"{path}/meta").first()[0]).get("history", [])


def load_model(spark: SparkSession, path: str) -> StagedModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    with ThreadPoolExecutor(MODEL_THREADS) as pool:
        stages = list(pool.map(lambda i: GBTRegressionModel.load(f"{path}/stage_{i:03d}"), range(meta["stages"])))
    return StagedModel(stages, meta["features"], meta["trained_at"], meta["training_rows"])
