"""Small frames for the operator tests."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])


def frame(spark, rows, extra=()):
    """documents from (doc_id, text) or (doc_id, text, lang); ``extra``: (name, value) columns."""
    from pyspark.sql import functions as F

    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name, value in extra:
        df = df.withColumn(name, F.lit(value))
    return df


def collected(df):
    return [r.asDict(recursive=True) for r in df.collect()]


SF = "/root/testdata/sf0.001"
