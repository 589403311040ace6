"""The event producer as a stream (T5): raw rows in, normalised JSON events out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.normalize import normalize_events, stamp_arrival
from ..sinks.events import to_event_json


def event_plan(raw: DataFrame, zones: DataFrame, keep: list[str] | None = None, clock=None) -> DataFrame:
    """Raw rows of any schema family -> ``keep`` and ``value``, the JSON of the normalised event.

    A projection and a filter of each row, batch or streaming: no state, no shuffle,
    so a stream needs no watermark.  ``clock`` is the arrival time (the present by default).
    """
    events = stamp_arrival(normalize_events(raw, zones, keep=keep), clock or F.current_timestamp())
    return to_event_json(events, keep=keep or [])


def run_event_stream(
    raw: DataFrame, zones: DataFrame, checkpoint: str, target: str | None = None, sink: str = "parquet",
    options: dict[str, str] | None = None, trigger: dict | None = None, await_termination: bool = True, **plan,
):
    """Stream raw rows through ``event_plan`` into a file folder, or into a broker with ``sink="kafka"`` and its options.

    The file sink commits each micro-batch once (its log lists the files that count).
    """
    writer = event_plan(raw, zones, **plan).writeStream.format(sink).outputMode("append")
    for key, value in {"checkpointLocation": checkpoint, **(options or {})}.items():
        writer = writer.option(key, value)
    q = writer.trigger(**(trigger or {"availableNow": True})).start(*([target] if target else []))
    if await_termination:
        q.awaitTermination()
    return q
