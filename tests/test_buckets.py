import re
from uuid import uuid4

import pytest
from conftest import rows
from pyspark.sql import functions as F

from docklake.sinks import buckets


@pytest.fixture
def busy(spark):
    """9 of 10 rows belong to station 7; some have no station."""
    station = F.when(F.col("id") % 10 > 0, 7).when(F.col("id") % 100 == 0, None).otherwise(F.col("id") % 50).cast("int")
    return spark.range(20_000).select(station.alias("station"), F.col("id").alias("time"), (F.col("id") % 13).alias("bikes"))


def stored(spark, folder, busy):
    plan = buckets.planned(busy, "station", folder, 2_000)
    name = uuid4().hex
    places = spark.range(50).select(F.col("id").cast("int").alias("station"), F.concat(F.lit("p"), "id").alias("place"))
    return plan, plan.write(busy, f"t{name}", "time"), plan.write_lookup(places, f"p{name}"), places


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_join_moves_no_facts(spark, folder, busy):
    _, facts, lookup, places = stored(spark, folder, busy)
    lookup = lookup.select(buckets.SLOT, "place")
    joined = facts.join(lookup, buckets.SLOT).select("station", "time", "bikes", "place")
    assert rows(joined) == rows(busy.join(places, "station").select("station", "time", "bikes", "place"))
    merged = facts.hint("merge").join(lookup, buckets.SLOT)
    assert "SortMergeJoin" in plan_of(merged) and "Exchange" not in plan_of(merged)


def test_busy_key_is_spread(spark, folder, busy):
    plan, facts, _, _ = stored(spark, folder, busy)
    assert plan.count == 10 and rows(plan.slots(spark)) == [(7, 18)]
    sizes = facts.groupBy(F.spark_partition_id()).count().collect()
    slots = facts.where("station = 7").groupBy(buckets.SLOT).count().collect()
    assert len(slots) == 18 and max(r["count"] for r in slots) < 1_400 and len(sizes) > 4
    assert rows(facts.drop(buckets.SLOT)) == rows(busy)


def test_one_key_is_read_from_its_buckets(spark, folder, busy):
    plan, facts, _, _ = stored(spark, folder, busy)
    quiet = plan.rows_of(facts, 20)
    assert rows(quiet.drop(buckets.SLOT)) == rows(busy.where("station = 20"))
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan prunes without telling
    try:
        assert re.search("SelectedBucketsCount: 1 out of 10", plan_of(plan.rows_of(facts, 20)))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert rows(plan.rows_of(facts, 7).drop(buckets.SLOT)) == rows(busy.where("station = 7"))
    assert rows(plan.rows_of(facts, 49_999)) == []


def test_empty_table(spark, folder, busy):
    plan, facts, lookup, _ = stored(spark, folder, busy.limit(0))
    assert plan.count == 1 and facts.count() == 0 and lookup.count() == 50 and plan.rows_of(facts, 7).count() == 0
