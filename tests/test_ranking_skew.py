from pyspark.sql import functions as F

from cropmill.operators import skew
from cropmill.operators.ranking import global_rank, random_key, rank_by_key
from cropmill.sources.tables import materialize


def test_ranks_of_hot_groups_equal_plain_ranks(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("hot")).alias("g")).withColumn("k", random_key("id"))
    plain = {(r.g, r.id): r["rank"] for r in rank_by_key(df, ["g"], "k", "id").collect()}
    cut = {(r.g, r.id): r["rank"] for r in rank_by_key(df, ["g"], "k", "id", rows_per_bucket=100).collect()}
    assert plain == cut and len(cut) == 5000
    assert sorted(v for (g, _), v in cut.items() if g == "hot") == list(range(3333))


def test_global_rank_with_ties(spark):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("v"))
    got = global_rank(df, [F.col("v").desc(), F.col("id")], materialize, rows_per_bucket=200).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 3001)) and [r.id for r in got] == [*range(1, 3000, 2), *range(0, 3000, 2)]
    assert global_rank(df.limit(0), [F.col("id")], materialize).count() == 0


def test_lookup_of_hot_keys(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    side = rows.groupBy("key").agg(F.count("*").alias("n"))
    hot = skew.hot_keys(side, least=100)
    assert [r.key for r in hot.collect()] == ["hot"]
    assert skew.lookup(rows, side, "key", hot).agg(F.count("*"), F.sum(F.when(F.col("key") == "hot", F.col("n")))).first()[:] == (1000, 160000)
    assert skew.lookup(rows.limit(0), side, "key", hot).count() == 0


def test_spread_of_hot_keys(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    side = spark.createDataFrame([("hot", 1), ("hot", 2), ("999", 3), ("absent", 4), (None, 5)], "key string, v int")
    hot = skew.hot_keys(rows.groupBy("key").agg(F.count("*").alias("n")), least=100)
    got = skew.spread(rows, side, "key", hot, ["id"], most=50)
    assert got.agg(F.count("*"), F.countDistinct("id", "v"), F.sum("v")).first()[:] == (801, 801, 400 * 3 + 3)
    assert skew.spread(rows, side, "key", hot.limit(0), ["id"]).count() == 801 and skew.spread(rows.limit(0), side, "key", hot, ["id"]).count() == 0
