"""Reshaping between the wide metric row and long time-series points.

Long form = one point per (time, series, field): ``_time`` (window end),
the three tags, ``_field`` and a double ``_value``; null or NaN fields are
absent, the row's other fields stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.schema import METRIC_FIELDS, SERIES_KEYS

# Types whose aggregation buffers are fixed-width (HashAggregate-able).
FIXED_WIDTH = ("bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date",
               "timestamp", "timestamp_ntz")


def pick_latest(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The row with the greatest ``order_col`` per key (which must be unique per key).

    When every carried column is fixed-width, one ``max_by(col, order)`` per
    column keeps the work in a hash aggregate (partial before the shuffle, no
    sort). Otherwise the row travels as one struct through ``max_by``, which
    Spark runs as a sort-based aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    types = dict(df.dtypes)
    if all(types[c] in FIXED_WIDTH for c in rest):
        aggs = [F.max_by(F.col(c), F.col(order_col)).alias(c) for c in rest]
        return df.groupBy(*keys).agg(*aggs).select(*keys, *rest)
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_row"))
    return last.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])


POINT_KEYS = ["_time", *SERIES_KEYS]


def metrics_long(df: DataFrame, fields: list[str] | None = None,
                 time_col: str = "window_end") -> DataFrame:
    """Wide metric rows → long points (``unpivot``, a narrow Expand: no shuffle)."""
    fields = METRIC_FIELDS if fields is None else fields
    wide = df.select(F.col(time_col).alias("_time"), *SERIES_KEYS,
                     *[F.col(f).cast("double").alias(f) for f in fields])
    long = wide.unpivot(POINT_KEYS, fields, "_field", "_value")
    return long.filter(F.col("_value").isNotNull() & ~F.isnan("_value"))


def metrics_pivot(points: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Long points → one row per (time, series) with a column per field.

    The field list is explicit (no job to discover pivot values) and each
    field is a conditional aggregate, so the reshape is ONE partial/final
    hash aggregate; ``groupBy().pivot()`` plans two (keys + field, then
    PivotFirst), i.e. a second shuffle of the long rows. A missing field
    comes back as null.
    """
    fields = METRIC_FIELDS if fields is None else fields
    return points.groupBy(*POINT_KEYS).agg(*[
        F.first(F.when(F.col("_field") == F.lit(f), F.col("_value")), ignorenulls=True).alias(f)
        for f in fields])


def upsert_latest(changelog: DataFrame, keys: list[str] | None = None,
                  version_col: str = "batch_id") -> DataFrame:
    """Keep the newest version of every key (update-mode output → current table).

    A re-emitted window (same series and window end) overwrites the earlier
    one; "newest" is the highest micro-batch id, not the processing time
    (equal within a batch). One partial/final aggregate.
    """
    keys = [*SERIES_KEYS, "window_end"] if keys is None else keys
    return pick_latest(changelog, keys, version_col).drop(version_col)
