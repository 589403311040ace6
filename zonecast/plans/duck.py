"""Small helpers for writing the DuckDB oracle text."""

from __future__ import annotations


def r(expr: str, digits: int) -> str:
    """DuckDB twin of ``functions.numeric.round_half_even``."""
    scale = f"{float(10 ** digits)!r}::double"
    return f"(round_even(({expr})*{scale}, 0)/{scale})"


def r6(expr: str) -> str:
    """Twin of ``functions.numeric.round6`` (9-dp then 6-dp rounding)."""
    return r(r(expr, 9), 6)


def r2(expr: str) -> str:
    return r(expr, 2)


def dist12(expr: str) -> str:
    return r(expr, 12)


# Stream-rule duration (whole epoch seconds) and speed, as SQL expressions over
# columns named pickup_ts/dropoff_ts/trip_distance.
def stream_measures(pickup: str = "pickup_ts", dropoff: str = "dropoff_ts") -> str:
    return (
        f"(epoch_us({dropoff})//1000000 - epoch_us({pickup})//1000000)/60.0::double as duration_min"
    )


SPEED = (
    "case when duration_min/60.0::double <> 0 then trip_distance/(duration_min/60.0::double) end"
    " as speed_mph"
)

F1 = (
    "pickup_ts is not null and dropoff_ts is not null and duration_min > 1 and duration_min < 180"
    " and trip_distance > 0.2 and trip_distance < 100 and speed_mph > 1 and speed_mph < 80"
    " and pu_location_id > 0"
)

F2 = F1 + (
    " and total_amount > 0 and total_amount < 500 and tip_amount is not null"
    " and tip_amount >= 0 and tip_amount < 100"
)
