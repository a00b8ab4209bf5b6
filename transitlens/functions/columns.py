"""Column-level functions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def vehicle_key(topic: Column, marker: str = "veh") -> Column:
    """Topic level right after the first level equal to ``marker``.

    Null when the marker is missing, is the last level, or the next level is
    empty. (``array_position`` is not used: "not found" is 0, and element 0
    would silently pick the first level.)
    """
    pattern = f"(?:^|/){re.escape(marker)}/([^/]*)"
    return F.nullif(F.regexp_extract(topic, pattern, 1), F.lit(""))


def topic_level(topic: Column, level: int) -> Column:
    """Topic level by 1-based position (levels split on '/'); null when absent or empty."""
    return F.nullif(F.try_element_at(F.split(topic, "/"), F.lit(level)), F.lit(""))


def topic_filter_regex(topic_filter: str) -> str:
    """Anchored regular expression for an MQTT-style subscription filter.

    ``+`` matches exactly one level (possibly empty); a trailing ``#`` matches
    the parent level and everything below it (``a/#`` also matches ``a``).
    """
    levels = topic_filter.split("/")
    if "#" in levels[:-1]:
        raise ValueError("'#' may only appear as the last level")
    tail = ""
    if levels[-1] == "#":
        levels = levels[:-1]
        tail = "(/.*)?" if levels else ".*"
    parts = ["[^/]*" if lv == "+" else re.escape(lv) for lv in levels]
    return "^" + "/".join(parts) + tail + "$"


def matches_topic(topic: Column, topic_filter: str) -> Column:
    return topic.rlike(topic_filter_regex(topic_filter))


def parse_time(text: Column) -> Column:
    """ISO-8601 text to a timestamp; null (not an error) on bad input under ANSI mode."""
    return F.try_to_timestamp(text)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def equals_filters(**values) -> Column:
    """AND of ``col == value`` for every given, non-empty value (empty = no filter)."""
    conds = [F.col(name) == F.lit(v) for name, v in values.items() if v not in (None, "")]
    return all_of(conds)
