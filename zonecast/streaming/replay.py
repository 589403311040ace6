"""File-backed event feed for Structured Streaming runs and tests.

The broker is replaced by a directory of JSON-lines files (one payload per
line, column ``value`` when read as text).  One distributed write makes the files:
rows are range-partitioned by event time and sorted inside each file, so the
files hold disjoint, ascending time spans.  Their modification times are then
set in that order (metadata only), which is the order in which a file stream
delivers them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sinks.tables import _fs

#: modification times are this far apart, in milliseconds
STEP_MS = 2000


def write_time_slices(
    events: DataFrame,
    time_col: str,
    directory: str,
    slices: int = 6,
    value_col: str = "value",
) -> int:
    """Write ``events`` as at most ``slices`` files of ascending time; returns how many.

    Equal times stay in one file.  Only file names reach the driver.
    """
    spark = events.sparkSession
    (
        events.repartitionByRange(slices, time_col)
        .sortWithinPartitions(time_col)
        .select(value_col)
        .write.text(directory)
    )
    fs, root = _fs(spark, directory)
    files = sorted(
        (st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith("part-")),
        key=lambda p: p.getName(),
    )
    newest = max((fs.getFileStatus(p).getModificationTime() for p in files), default=0)
    for n, p in enumerate(files):
        fs.setTimes(p, newest - STEP_MS * (len(files) - 1 - n), -1)
    return len(files)
