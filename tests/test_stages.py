import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from citypulse.operators.models.stages import MeanEncoder, MedianImputer, Standardizer


@pytest.fixture(scope="module")
def trips(spark):
    rng = np.random.RandomState(2)
    rows = [(i, f"z{i % 5}" if i % 11 else None, int(i % 3), float(rng.normal(10, 2)) if i % 7 else None,
             float(i % 5 + rng.normal(0, .1))) for i in range(400)]
    return spark.createDataFrame(rows, "id long, zone string, mode int, speed double, y double")


def steps():
    return [MeanEncoder(encodings={"zone_mean": ["zone"], "both mean": ["zone", "mode"]}, labelCol="y"),
            MedianImputer(inputCols=["speed"]), Standardizer(inputCols=["speed_filled", "zone_mean"]),
            VectorAssembler(inputCols=["speed_filled_scaled", "zone_mean_scaled"], outputCol="features"),
            LinearRegression(labelCol="y", featuresCol="features")]


def test_pipeline_of_all_stages_survives_save_and_load(spark, trips, tmp_path):
    train, test = trips.where("id < 300"), trips.where("id >= 300")
    model = Pipeline(stages=steps()).fit(train)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    cols = ["id", "zone_mean", "both mean", "speed_filled", "speed_filled_scaled", "prediction"]
    a, b = [[tuple(r) for r in m.transform(test).select(*[f"`{c}`" for c in cols]).orderBy("id").collect()]
            for m in (model, again)]
    assert a == b and len(a) == 100


def test_unfitted_pipeline_survives_too(spark, trips, tmp_path):
    Pipeline(stages=steps()).write().overwrite().save(str(tmp_path / "p"))
    again = Pipeline.load(str(tmp_path / "p"))
    want, got = [p.fit(trips).transform(trips).orderBy("id").toPandas()["prediction"].to_numpy()
                 for p in (Pipeline(stages=steps()), again)]
    assert np.array_equal(want, got)


def test_values_are_those_of_pandas(spark, trips):
    p = trips.toPandas()
    out = Pipeline(stages=steps()[:3]).fit(trips).transform(trips).orderBy("id").toPandas()
    filled = p["speed"].fillna(p["speed"].median())
    assert np.allclose(out["speed_filled"], filled)
    assert np.allclose(out["speed_filled_scaled"], (filled - filled.mean()) / filled.std(ddof=0))
    mean = p["zone"].map(p.groupby("zone")["y"].mean())
    known = p["zone"].notna()
    assert np.allclose(out["zone_mean"][known], mean[known])


def test_new_keys_absent_columns_and_no_spread(spark, trips):
    model = MeanEncoder(encodings={"m": ["zone"]}, labelCol="y").fit(trips)
    overall = trips.toPandas()["y"].mean()
    got = model.transform(spark.createDataFrame([("new",)], "zone string")).first()["m"]
    assert np.isclose(got, overall)
    flat = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (None, None)], "a double, b double")
    scaled = Standardizer(inputCols=["a", "absent", "b"]).fit(flat).transform(flat)
    assert scaled.columns == ["a", "b", "a_scaled", "b_scaled"]
    assert [tuple(r) for r in scaled.select("a_scaled", "b_scaled").collect()] == [(-1.0, 0.0), (1.0, 0.0), (None, None)]
    empty = Standardizer(inputCols=["a"]).fit(flat.where("a > 9")).transform(flat)
    assert empty.where("a_scaled != 0").count() == 0
