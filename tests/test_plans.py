import pytest
from pyspark.sql import functions as F

from corpusloom.plans import (
    broadcast_if_bounded,
    cut_lineage,
    first_per_key,
    hot_keys,
    is_bounded,
    salted_join,
    shared_dir,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds a third of all rows."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("key")
    )


@pytest.fixture(scope="module")
def right(spark):
    return spark.range(0, 60, 2).select(F.col("id").alias("key"), (F.col("id") * 10).alias("value"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_a_plain_join(skewed, right, how):
    salted = salted_join(skewed, right, ["key"], ["id"], how=how, hot_rows=100)
    plain = skewed.join(right, "key", how)
    assert sorted(salted.collect()) == sorted(plain.select(*salted.columns).collect())


def test_hot_keys_are_split_evenly(skewed):
    counts = skewed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(counts, ["key"], "n", hot_rows=100).collect()
    assert [(r["key"], r["_splits"]) for r in hot] == [(0, 11)]
    salts = skewed.where("key = 0").groupBy(F.pmod(F.xxhash64("id"), F.lit(11))).count()
    assert salts.count() == 11 and salts.agg(F.max("count")).first()[0] < 200


def test_first_per_key_prunes_before_the_shuffle(skewed, capsys):
    first = first_per_key(skewed, ["key"], [F.desc("id")])
    assert first.count() == skewed.select("key").distinct().count()
    assert first.where("key = 0").first()["id"] == 2997
    first.explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2


def test_size_checks(skewed):
    assert is_bounded(skewed) and not is_bounded(skewed, max_rows=2999)
    assert not is_bounded(skewed, max_bytes=1000)
    assert broadcast_if_bounded(skewed)[1] and not broadcast_if_bounded(skewed, max_rows=1)[1]


def test_lineage_is_cut_through_the_configured_folder(spark, skewed):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert cut_lineage(skewed).count() == 3000
