"""Hourly rows of a metric store, kept up to date from what changed.

The source's manifest says which hours its last commits touched. A refresh
computes only these hours anew, from the dates that they lie in, and upserts
them into a store of its own; the number of the source's manifest is the batch
id, so that a refresh that is repeated changes nothing. Where the source no
longer remembers (after a bulk load, or too many commits ago) all is computed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from transitlens.operators.extensions import downsample
from transitlens.operators.store import MetricStore
from transitlens.schema import TUMBLING_LABEL

LABEL = "rollup_1h"


def refresh(source: MetricStore, target: MetricStore, window_type: str = TUMBLING_LABEL) -> int | None:
    """Bring ``target`` up to ``source``; returns the number of hours computed, None for all.

    ``source`` needs the numbers behind its means (``window_metrics(counts=True)``).
    """
    m = source.manifest()
    hours = m.touched_since(target.manifest().batch)
    if hours is None:
        rows = source.read(at=m)
    else:
        # A window of an hour ends in it or at its end, which may be the next date's midnight.
        dates = {(dt.datetime.fromisoformat(h) + dt.timedelta(hours=k)).date().isoformat() for h in hours for k in (0, 1)}
        rows = source.read(dates=[d for d in m.dates if d in dates], at=m).filter(
            F.date_trunc("hour", "window_start").cast("timestamp_ntz").cast("string").isin(sorted(hours)))
    if hours is None or hours:
        target.commit(downsample(rows.drop("window_date"), "1 hour", window_type).withColumn("window_type", F.lit(LABEL)), m.version)
    return None if hours is None else len(hours)
