"""Final presentation step for compared results.

Sums of doubles depend on the order partial aggregates are merged, so two
engines (or two runs) agree only up to the last bits; every double is rounded
to six decimals. Plain rounding is fragile when the exact value is a tie
(e.g. a mean over 32 rows ending in ...5 at the 7th decimal): a few ulps
decide the direction. So values are first snapped to nine decimals as
DECIMAL (absorbing summation noise), then rounded half-up to six. Zone-aware
timestamps are shown as UTC wall-clock (``timestamp_ntz``), the type of the
stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampType

DIGITS = 6
SNAP = "decimal(38,9)"


def stable_round(c, digits: int = DIGITS):
    """Half-up rounding that does not depend on the last bits of ``c``."""
    snapped = F.round(c.try_cast(SNAP), digits).cast("double")
    return F.when(F.isnan(c), c).otherwise(snapped)


def finalize(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (DoubleType, FloatType)):
            c = stable_round(c, digits)
        elif isinstance(field.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(field.name))
    return df.select(*cols)
