import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from citypulse.operators.dedup import keep_first
from citypulse.operators.splits import contiguous_kfold, random_split, stratified_split


def test_keep_first_matches_pandas_file_order(spark):
    rng = np.random.RandomState(3)
    pdf = pd.DataFrame({"row": np.arange(500), "k1": rng.randint(0, 5, 500),
                        "k2": rng.randint(0, 3, 500), "x": rng.rand(500)})
    got = keep_first(spark.createDataFrame(pdf), ["k1", "k2"], ["row"]).toPandas()
    exp = pdf.drop_duplicates(["k1", "k2"])
    assert sorted(got["row"]) == sorted(exp["row"])


def test_contiguous_kfold_sizes_like_sklearn(spark):
    df = spark.range(11).withColumnRenamed("id", "i")
    sizes = (contiguous_kfold(df, ["i"], 5).groupBy("fold").count().orderBy("fold")
             .toPandas()["count"].tolist())
    assert sizes == [3, 2, 2, 2, 2]
    firsts = contiguous_kfold(df, ["i"], 5).groupBy("fold").agg(F.min("i")).orderBy("fold")
    assert [r[1] for r in firsts.collect()] == [0, 3, 5, 7, 9]


def test_random_split_is_stable_under_repartition(spark):
    df = spark.range(2000).withColumnRenamed("id", "rid")
    a = random_split(df, "rid").where("is_test = 1").select("rid")
    b = random_split(df.repartition(13), "rid").where("is_test = 1").select("rid")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    frac = a.count() / 2000
    assert 0.15 < frac < 0.25


def test_stratified_split_keeps_class_shares(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    s = stratified_split(df, "y", "id", 0.2).groupBy("y", "is_test").count().toPandas()
    pos_test = int(s[(s.y == 1) & (s.is_test == 1)]["count"].iloc[0])
    assert pos_test == 20


def test_keep_first_null_order_and_keys_without_a_sort_of_the_rows(spark):
    """A null leads the order, null keys are a key, and whole rows are compared
    only where they hold their key's least leading value."""
    rows = [(1, "a", 5, "x", 1.0), (1, "a", None, "y", 2.0), (1, "a", None, "w", 3.0), (None, "a", 4, "z", 4.0),
            (None, "a", 3, None, 5.0), (None, "a", 3, "q", 6.0), (2, None, 7, "p", 7.0)]
    df = spark.createDataFrame(rows, "k1 int, k2 string, a long, b string, v double")
    out = keep_first(df, ["k1", "k2"], ["a", "b"])
    assert out.columns == df.columns
    assert sorted(r["v"] for r in out.collect()) == [3.0, 5.0, 7.0]
    # over a join, rows are ruled out before they move
    names = spark.createDataFrame([(1, "one"), (2, "two")], "k1 int, name string")
    joined = df.select("k1", "k2", (df["a"] * 2).alias("a"), "b", "v").join(names, "k1")
    out = keep_first(joined, ["name"], ["a", "b"])
    assert {r["name"]: r["v"] for r in out.collect()} == {"one": 3.0, "two": 7.0}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Inner") < plan.index("ExistenceJoin"), plan


def test_stratified_split_moves_no_class_to_one_task(spark):
    from pyspark.sql import functions as F

    from citypulse.operators.splits import stratified_split
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 10, 1).when(F.col("id") < 980, 0).alias("y"))
    out = stratified_split(df, "y", "id", 0.2, 42)
    assert {(r["y"], r["n"]) for r in out.where("is_test = 1").groupBy("y").agg(F.count("*").alias("n")).collect()} == {
        (1, 2), (0, 194), (None, 4)}
    assert out.columns == ["id", "y", "is_test", "split_mode"]
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    assert joins and all("_cp_blk" in x for x in joins), joins


def test_balanced_weights_without_a_join(spark):
    from citypulse.operators.models.supervised import balanced_weights
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (4, 1), (5, None)], "id int, y int")
    out = balanced_weights(df, "y")
    assert out.columns == ["y", "id", "w"]
    assert {r["id"]: round(r["w"], 6) for r in out.collect()} == {k: round(5 / 9, 6) for k in (1, 2, 3)} | {4: round(5 / 3, 6)}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
