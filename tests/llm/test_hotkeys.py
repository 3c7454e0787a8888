from pyspark.sql import functions as F

from tessera.llm import hotkeys


def test_hot_keys_are_salted_and_joined_whole(spark, monkeypatch):
    monkeypatch.setattr(hotkeys, "HOT_ROWS", 5)
    rows = spark.range(400).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).cast("long").alias("a"), F.lit("x").alias("b"), "id")
    counts = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("a <> 7").withColumn("more", F.col("a") * 2)
    got = hotkeys.join_counted(rows, counts, ["a", "b"], "n", 400, F.xxhash64("id"))
    assert got.columns == ["a", "b", "id", "n", "more"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(counts, ["a", "b"]).collect()))
    assert hotkeys.join_counted(rows.limit(0), counts, ["a", "b"], "n", 0, F.xxhash64("id")).count() == 0
    assert hotkeys.join_counted(rows, counts.where("n < 0"), ["a", "b"], "n", 400, F.xxhash64("id")).count() == 0
