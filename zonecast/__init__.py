"""zonecast: zone/window trip analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers (parquet families, zone CSV, JSON events, test-table adapter)
functions  Column-expression helpers (rounding, time, geo distance)
operators  DataFrame -> DataFrame transforms (quality, aggregates, selection, geo, scoring, live views)
sinks      writers (keyed upsert, retention append, snapshots, exports)
streaming  Structured Streaming jobs (sliding aggregate, raw live feed)
ml         feature frame, boosted-tree training and scoring
plans      the query catalogue used by ``__spark_entry__`` and ``bench.py``
"""

__version__ = "0.1.0"
