from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from transitlens.llm import common


def test_stored_keeps_rows_and_settings(spark):
    before = spark.conf.get(common.CLEANUP, "false")
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    got = common.stored(counts, "test-counts")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, counts.collect()))
    assert spark.conf.get(common.CLEANUP) == before
    with pytest.raises(Exception, match="stop here"):
        common.stored(spark.range(1).select(F.raise_error(F.lit("stop here")).cast("string").alias("x")), "test-fails")
    assert spark.conf.get(common.CLEANUP) == before


def test_temporary_tables_go(spark):
    """Tables of a block go at its end but for those kept; what an inner block keeps is the outer block's."""
    def there(df):
        return [os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in df.inputFiles()]

    with common.temporary(spark) as keep:
        first = common.stored(spark.range(5), "test-first")
        with common.temporary(spark) as keep_inside:
            gone, left = common.stored(spark.range(6), "test-gone"), common.stored(spark.range(7), "test-left")
            both = keep_inside(left.join(first, "id"))
        assert not any(there(gone)) and all(there(both)) and both.count() == 5
        kept = keep(common.stored(both, "test-kept"))
    assert kept.count() == 5 and not any(there(first) + there(left))
    with pytest.raises(ValueError), common.temporary(spark):
        failed = common.stored(spark.range(5), "test-failed")
        raise ValueError
    assert not any(there(failed))
    outside = common.stored(spark.range(5), "test-outside")
    assert outside.count() == 5 and all(there(outside))


def test_a_worker_keeps_the_tables_of_one_operator():
    """What other operators have kept goes when one begins; its own stays."""
    from transitlens.llm import bpe_coding, near_dedup, quality_rules
    near_dedup.word_hashes("some words")
    bpe_coding._CODES["file"] = "codes"
    common.keep_only("near_dedup")
    assert not bpe_coding._CODES and near_dedup._HASHES
    assert len(quality_rules.stats_of.func(pa.array(["a b", None] * 1500))) == 3000
    assert not near_dedup._HASHES
