import hashlib

from pyspark.sql import functions as F

from custgraph.functions import skew
from custgraph.functions.skew import global_rank, hot_keys, rank_in_class, salted_join, top_per_key


def test_salted_join_equals_plain_join(spark):
    big = spark.range(3000).select(F.when(F.col("id") < 1200, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("inner", "left"):
        salted = salted_join(big, small, "k", ["v"], how, per_slice=100)
        assert sorted(map(tuple, salted.select("k", "v", "w").collect()), key=str) == sorted(
            map(tuple, big.join(small, "k", how).select("k", "v", "w").collect()), key=str
        )


def test_every_hot_key_is_counted(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k")).unionAll(spark.range(500).select(F.lit(3).alias("k")))
    hot = {r["k"]: r["fan"] for r in hot_keys(df, "k", slice_rows=200).collect()}
    assert hot == {3: 3}
    assert hot_keys(df, "k", slice_rows=1).count() == 10


def test_rank_in_class_is_the_exact_md5_order(spark):
    df = spark.range(5000).select(F.col("id").alias("customer_id"), F.when(F.col("id") < 4000, "a").otherwise("b").alias("c"))
    got = {r["customer_id"]: (r["class_rank"], r["class_size"]) for r in rank_in_class(df, ["c"], "customer_id", 42).collect()}
    for members in (range(4000), range(4000, 5000)):
        order = sorted(members, key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
        assert all(got[i] == (n, len(order)) for n, i in enumerate(order, 1))


def test_global_rank_with_one_hot_value(spark):
    df = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("x"))
    got = {r["id"]: r["rank"] for r in global_rank(df.repartition(7), "x", "id").collect()}
    order = sorted(range(2000), key=lambda i: (5 if i % 3 == 0 else i % 11, i))
    assert [got[i] for i in order] == list(range(1, 2001))


def test_top_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    top = top_per_key(df, ["k"], [F.desc("id")], 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert top.count() == 6


def test_rows_are_dealt_by_the_size_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(skew, "DEAL_ROWS", 100)
    df = spark.range(1000).select((F.col("id") % 700).alias("k")).coalesce(1)
    dealt = skew.deal(df, 1000, "k")
    assert dealt.rdd.getNumPartitions() == 10 and skew.deal(df, 100, "k") is df
    assert sorted(dealt.collect()) == sorted(df.collect())
