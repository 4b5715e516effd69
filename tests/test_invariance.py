"""Results do not depend on partitioning."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
KEYS = ["process_waterfall", "message_fold", "fetch_outcome", "next_batch", "lookup_attributes",
        "clean_token_names", "stable_shuffle", "scan_index"]


def snapshot(spark, key):
    df = E.queries()[key](spark, SF)
    cols = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


@pytest.mark.parametrize("key", KEYS)
def test_partitioning_invariance(spark, key):
    results = []
    for parts, split in ((1, "128m"), (4, "16k"), (7, "4k")):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            results.append(snapshot(spark, key))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert results[0] == results[1] == results[2]
    assert results[0]
