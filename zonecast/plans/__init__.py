"""Query catalogue.  Importing this package registers every query."""

from __future__ import annotations

from . import files, ingest, live, models, monitor, scoring, streams, traffic, training  # noqa: F401
from .registry import REGISTRY, Entry, query  # noqa: F401


def queries():
    return {name: e.fn for name, e in REGISTRY.items()}


def oracle_sql():
    return {name: e.oracle for name, e in REGISTRY.items() if e.oracle is not None}


_KIND = {
    "traffic_agg_stream": "stream",
    "live_trips_stream": "stream",
    "live_stray_events": "stream",
    "normalize_events_stream": "stream",
    "quarantine_stream": "stream",
    "live_prediction_errors": "stream",
    "monthly_histograms": "files",
    "monthly_volume": "files",
    "monthly_quantiles": "files",
    "busiest_zones_monthly": "files",
    "contract_counts": "files",
    "stored_table_checks": "files",
    "stage_history": "model",
    "metrics_document": "model",
    "model_reload": "model",
    "score_cycle": "model",
    "score_changed_zones": "files",
    "train_features_from_files": "files",
    "csv_export": "files",
    "incremental_history": "files",
    "upsert_after_restart": "files",
    "live_append_after_restart": "files",
    "train_metrics": "model",
    "predict_zones_gbt": "model",
    "predict_trips": "model",
    "scan_trips": "files",
    "schema_family_union": "files",
}


def kind(name: str) -> str:
    """batch | stream (micro-batch replay) | model (training) | files (writes a file set)."""
    return _KIND.get(name, "batch")


def headline():
    return [name for name, e in REGISTRY.items() if e.headline]
