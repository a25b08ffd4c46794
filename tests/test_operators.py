"""Skew-proof operators against their plain forms."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from crmfunnel.operators.asof import as_of
from crmfunnel.operators.distinct import conditional_distinct, conditional_distinct_with_total
from crmfunnel.operators.keyed import first_per_key, latest_per_key
from crmfunnel.operators.previous import with_previous_time

BASE = dt.datetime(2025, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    """A third of the rows on one key, NULL keys, repeated times."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rnd.randrange(40)}"
        rows.append((f"{i:05d}", key, BASE + dt.timedelta(minutes=rnd.randrange(60 * 24 * 5)), rnd.choice("abc"),
                     rnd.randrange(5)))
    return spark.createDataFrame(rows, "id string, key string, at timestamp_ntz, kind string, n int").repartition(6)


def same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_previous_time_equals_lag(events):
    plain = events.withColumn("prev", F.lag("at").over(Window.partitionBy("key").orderBy("at", "id")))
    for bucket in ("minute", "hour", "day"):
        assert same(with_previous_time(events, ["key"], "at", "id", "prev", bucket), plain)


def test_picks_equal_row_number(events):
    rows = events.filter("key is not null")
    w = Window.partitionBy("key")
    first = rows.withColumn("rn", F.row_number().over(w.orderBy("at", "id"))).filter("rn = 1").select("key", "id", "kind")
    last = rows.withColumn("rn", F.row_number().over(w.orderBy(F.desc("at"), F.desc("id")))).filter("rn = 1").select(
        "key", "id", "kind")
    assert same(first_per_key(rows, ["key"], ["at"], ["id", "kind"]), first)
    assert same(latest_per_key(rows, ["key"], ["at"], ["id", "kind"]), last)


def test_two_phase_counts_equal_count_distinct(events):
    flags = {"a": F.col("kind") == "a", "big": F.col("n") > 2}
    direct = events.groupBy("kind").agg(
        F.count_distinct(F.when(F.col("kind") == "a", F.col("key"))).alias("a"),
        F.count_distinct(F.when(F.col("n") > 2, F.col("key"))).alias("big"), F.sum("n").alias("total"))
    assert same(conditional_distinct(events, ["kind"], "key", flags, {"total": F.col("n")}), direct)


def test_group_of_null_entities_is_kept(spark):
    df = spark.createDataFrame([("x", None), ("y", "k")], "g string, key string")
    got = {r.g: r.n for r in conditional_distinct(df, ["g"], "key", {"n": F.lit(True)}).collect()}
    assert got == {"x": 0, "y": 1}


def test_total_counts_a_shared_entity_once(spark):
    df = spark.createDataFrame([("x", "k"), ("y", "k"), ("y", "m")], "g string, key string")
    got = {r.g: r.n for r in conditional_distinct_with_total(df, ["g"], "key", {"n": F.lit(True)}).collect()}
    assert got == {"x": 1, "y": 2, "Total": 2}


def test_as_of_equals_brute_force(events, spark):
    changes = events.filter("key is not null and n < 2").select(
        "key", F.col("at").alias("changed"), F.col("id").alias("owner"))
    asked = events.filter("kind = 'a' and key is not null").select("id", "key", "at")
    got = {r.id: (r.owner_before, r.owner_after) for r in as_of(asked, changes, "key", "at", "id", "changed", "owner").collect()}
    by_key: dict = {}
    for r in changes.collect():
        by_key.setdefault(r.key, []).append((r.changed, r.owner))
    for r in asked.collect():
        earlier = [c for c in by_key.get(r.key, []) if c[0] < r.at]
        later = [c for c in by_key.get(r.key, []) if c[0] >= r.at]
        assert got[r.id] == (max(earlier)[1] if earlier else None, min(later)[1] if later else None)
    assert len(got) == asked.count()


def test_counts_plan_has_no_expand(events):
    df = conditional_distinct(events, ["kind"], "key", {"a": F.col("n") > 1, "b": F.col("n") > 2})
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_bloom_filter_keeps_every_key_and_few_others(spark):
    from crmfunnel.operators import bloom
    keys = spark.range(0, 20_000).select((F.col("id") * 7).alias("k"))
    fil = bloom.build(keys, "k")
    probe = spark.range(0, 140_000).withColumn("in", bloom_col := fil.might_contain(F.col("id")))
    assert bloom_col is not None
    counts = {r["member"]: r["n"] for r in probe.groupBy((F.col("id") % 7 == 0).alias("member"))
              .agg(F.sum(F.col("in").cast("int")).alias("n")).collect()}
    assert counts[True] == 20_000  # no key is ever dropped
    assert counts[False] < 0.02 * 120_000
    assert spark.range(1).select(fil.might_contain(F.lit(None).cast("long"))).first()[0] is False
    assert bloom.size_for(0) == bloom.MIN_BITS and bloom.size_for(10**12) == bloom.MAX_BITS


def test_orphan_extensions_leave_before_the_join(spark, tables):
    from crmfunnel.plans import prep
    acts = [{"id": i, "prospect_id": i % 50, "type_id": 1, "created_at": dt.datetime(2024, 6, 1)} for i in range(200)]
    # 98 % of the extension rows have no activity
    ext = [{"related_activity_id": i, "owner_id": i % 9, "status": "s"} for i in range(0, 200, 10)]
    ext += [{"related_activity_id": 100_000 + i, "owner_id": 1, "status": "o"} for i in range(980)]
    t = tables(activity_base=acts, activity_type=[{"id": 1, "activity_code": 7}], activity_extension=ext)
    pruned = prep.unified_activity(t)
    plain = prep.unified_activity(t, prune_orphans=False)
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, plain.collect()))
    ext_df = t["activity_extension"].select(F.col("related_activity_id").alias("activity_id"))
    fil = prep.bloom.build(t["activity_base"].select(F.col("id").alias("activity_id")), "activity_id")
    reaching = ext_df.filter(fil.might_contain(F.col("activity_id"))).count()
    assert 20 <= reaching <= 20 + 30  # the 20 matched rows and a few false positives of 980
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "substring" in text and "xxhash64" in text


def test_bloom_filter_of_many_keys_is_in_no_plan_text(spark):
    from crmfunnel.operators import bloom
    keys = spark.range(0, 3_000).select((F.col("id") * 7).alias("k"))
    fil = bloom.build(keys, "k", keys=1_000_000)  # 2 MB
    df = spark.range(0, 21_000).filter(fil.might_contain(F.col("id")))
    assert 3_000 <= df.count() <= 3_010
    assert df.filter("id % 7 = 0").count() == 3_000
    query = df._jdf.queryExecution()
    assert max(len(query.optimizedPlan().toString()), len(query.executedPlan().toString())) < 100_000


def test_plan_texts_of_the_activity_stream_stay_small_with_a_large_filter(spark, tables, monkeypatch):
    from crmfunnel.plans import prep
    monkeypatch.setattr(prep.bloom, "MIN_BITS", 22)  # 512 KB, as for 400,000 activities
    acts = [{"id": i, "prospect_id": i % 5, "type_id": 1, "created_at": dt.datetime(2024, 6, 1)} for i in range(20)]
    ext = [{"related_activity_id": i, "owner_id": 1, "status": "s"} for i in range(40)]
    t = tables(activity_base=acts, activity_type=[{"id": 1, "activity_code": 7}], activity_extension=ext)
    for df in (prep.unified_activity(t), prep.activity_appended(t), prep.activity_with_source(t)):
        assert df.count() == 20
        query = df._jdf.queryExecution()
        assert max(len(query.optimizedPlan().toString()), len(query.executedPlan().toString())) < 200_000
