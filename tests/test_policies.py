import json

import pytest

from siltstone.operators.lifecycle import HashKey, MergePolicy, RangeKey
from siltstone.plans import policies


def test_retention_and_hot_span():
    kept = policies.retention('{"SoftDeletePeriod": "30.00:00:00", "Recoverability": "Disabled"}')
    assert (kept.soft_delete, kept.recoverable) == ("30.00:00:00", False)
    assert policies.hot_span('{"DataHotSpan": {"Value": "3.00:00:00"}}') == policies.hot_span('{"DataHotSpan": "3.00:00:00"}') == "3.00:00:00"
    with pytest.raises(ValueError, match="lacks"):
        policies.hot_span("{}")
    with pytest.raises(ValueError):
        policies.retention("[]")


def test_merging_has_defaults():
    assert policies.merging("{}") == MergePolicy()
    custom = policies.merging('{"MaxExtentsToMerge": 7, "AllowMerge": false, "Lookback": {"Kind": "Custom", "CustomPeriod": "14.00:00"}}')
    assert (custom.max_files, custom.allow_merge, custom.period(None)) == (7, False, "14.00:00")
    assert policies.merging('{"Lookback": {"Kind": "HotCache"}}').period("3d") == "3d"


def test_batching():
    got = policies.batching('{"MaximumBatchingTimeSpan": "00:10:00", "MaximumNumberOfItems": 500, "MaximumRawDataSizeMB": 100}')
    assert (got.max_items, got.max_bytes, got.max_span_micros) == (500, 104857600, 600_000_000)


def test_partitioning():
    document = {"EffectiveDateTime": "2020-01-01T00:00:00Z", "PartitionKeys": [
        {"ColumnName": "f1", "Kind": "Hash", "Properties": {"Function": "XxHash64", "MaxPartitionCount": 64, "Seed": 2, "PartitionAssignmentMode": "Uniform"}},
        {"ColumnName": "f3", "Kind": "UniformRange", "Properties": {"Reference": "1990-01-01T00:00:00Z", "RangeSize": "2.00:00:00", "OverrideCreationTime": True}},
    ]}
    got = policies.partitioning(json.dumps(document))
    assert list(got.keys) == [HashKey("f1", 64, 2, "Uniform"), RangeKey("f3", "2.00:00:00", "1990-01-01T00:00:00Z", True)]
    document["PartitionKeys"][0]["Properties"]["Function"] = "Md5"
    with pytest.raises(ValueError, match="hash function"):
        policies.partitioning(json.dumps(document))


def test_update_policies():
    text = '[{"IsEnabled": false, "Source": "a", "Query": "q", "IsTransactional": true, "PropagateIngestionProperties": true}, {"Source": "b", "Query": "r"}]'
    one, two = policies.update_policies(text, "t")
    assert (one.enabled, one.transactional, one.propagate, one.target) == (False, True, True, "t")
    assert (two.enabled, two.transactional, two.propagate, two.source) == (True, False, False, "b")


def test_times_with_a_zone_mark(spark):
    from pyspark.sql import functions as F
    from siltstone.operators.lifecycle import ntz

    assert str(spark.range(1).select(ntz("1990-01-01T00:00:00Z")).first()[0]) == "1990-01-01 00:00:00"


def test_switches_and_rates(spark):
    assert policies.is_enabled('{"IsEnabled": true}') and not policies.is_enabled('{"IsEnabled": false}')
    for bad in ("{}", '{"IsEnabled": "yes"}', "[]"):
        with pytest.raises(ValueError):
            policies.is_enabled(bad)
    none, some = policies.streaming_ingestion('{"IsEnabled": false, "HintAllocatedRate": null}'), policies.streaming_ingestion('{"IsEnabled": true, "HintAllocatedRate": "1.5"}')
    assert (none.enabled, none.max_bytes("1m")) == (False, None) and (some.enabled, some.max_bytes("1h")) == (True, 3 * 1024**3 // 2)
    with pytest.raises(ValueError, match="positive"):
        policies.streaming_ingestion('{"IsEnabled": true, "HintAllocatedRate": "0"}')
    from siltstone.operators.security import secured

    rows = spark.range(10)
    for on, left in (("true", 3), ("false", 10)):
        policy = policies.row_security('{"IsEnabled": %s, "Query": "SELECT * FROM {source} WHERE id < 3"}' % on)
        assert secured(rows, policy, "me").count() == left
    groups = spark.createDataFrame([("small",), ("default",)], "group_name string")
    text = '{"IsEnabled": %s, "ClassificationFunction": "CASE WHEN id < 2 THEN \'small\' WHEN id < 4 THEN \'gone\' END"}'
    for on, small in (("true", 2), ("false", 0)):
        got = policies.classification(text % on).apply(rows, groups)
        assert got.where("workload_group = 'small'").count() == small and got.where("workload_group = 'default'").count() == 10 - small
