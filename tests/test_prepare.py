import pytest
from pyspark.sql import functions as F

from dailyseries.functions.scalar import inf_to_null
from dailyseries.operators import prepare as prep


def table(spark):
    rows = [("train", 1.0, 5.0, None, "a"), ("train", 3.0, 5.0, None, None), ("train", None, 5.0, None, "b"),
            ("val", 10.0, 7.0, 1.0, "c"), ("test", None, 5.0, 2.0, "a")]
    return spark.createDataFrame(rows, "split string, x double, const double, allnull double, cat string")


def test_impute_and_scale_fit_on_train(spark):
    df = table(spark)
    out = prep.scale(prep.impute(df, ["x"], "mean"), ["x"], "standard").orderBy("split", "x").collect()
    xs = {(r["split"], round(r["x"], 9)) for r in out}
    # train mean 2, imputed train [1, 3, 2] -> population std sqrt(2/3)
    sd = (2 / 3) ** 0.5
    assert ("val", round((10 - 2) / sd, 9)) in xs and ("test", 0.0) in xs


def test_constant_column_divisor_one(spark):
    df = table(spark)
    out = prep.scale(df, ["const"], "standard").select("const").distinct().collect()
    assert sorted(r[0] for r in out) == [0.0, 2.0]
    mm = prep.scale(df, ["const"], "minmax").where("split = 'train'").select("const").distinct().collect()
    assert [r[0] for r in mm] == [0.0]


def test_all_null_train_column(spark):
    df = table(spark)
    with pytest.raises(ValueError):
        prep.impute(df, ["allnull"], "mean")
    kept = prep.impute(df, ["allnull"], "mean", on_empty="null")
    assert kept.where(F.col("allnull").isNotNull()).count() == 2


def test_median_and_mode(spark):
    df = spark.createDataFrame([("train", 1.0), ("train", 2.0), ("train", 2.0), ("train", 9.0), ("train", None),
                                ("val", None)], "split string, x double")
    assert prep.fit_impute(df, ["x"], "median")["x"] == 2.0
    ties = spark.createDataFrame([("train", 3.0), ("train", 1.0), ("train", 3.0), ("train", 1.0)], "split string, x double")
    assert prep.fit_impute(ties, ["x"], "most_frequent")["x"] == 1.0


def test_one_hot_null_and_known_categories(spark):
    df = spark.createDataFrame([(1, "Summer"), (2, None), (None, "Winter")], "weather_code int, season string")
    out = prep.one_hot(df, ["weather_code", "season", "missing"])
    assert out.columns == ["weather_code_1", "weather_code_2", "season_Summer", "season_Autumn",
                           "season_Winter", "season_Spring"]
    rows = [tuple(r) for r in out.collect()]
    assert (0, 1, 0, 0, 0, 0) in rows and (0, 0, 0, 0, 1, 0) in rows


def test_inf_to_null(spark):
    df = spark.createDataFrame([(float("inf"), 1), (float("nan"), 2), (-float("inf"), 3), (1.5, 4)], "a double, b int")
    assert [r["a"] for r in inf_to_null(df).orderBy("b").collect()] == [None, None, None, 1.5]


def test_scale_rejects_unknown_method(spark):
    with pytest.raises(ValueError):
        prep.fit_scale(table(spark), ["x"], "robust")


def test_one_hot_keeps_types_and_skips_nan(spark):
    df = spark.createDataFrame([(1.5, "b", 3), (float("nan"), "a", 4), (None, None, None), (2.0, "1e5", 3)],
                               "d double, s string, i int")
    assert prep.fit_one_hot(df, ["d", "s", "i"]) == {"d": [1.5, 2.0], "s": ["1e5", "a", "b"], "i": [3, 4]}
    assert prep.one_hot(df, ["d"]).columns == ["s", "i", "d_1.5", "d_2.0"]


def test_one_hot_vector_takes_many_categories(spark):
    df = spark.createDataFrame([(i, "train" if i < 1500 else "test") for i in range(1600)] + [(None, "train")],
                               "c int, split string")
    got = prep.one_hot_vector(df, "c", "v").collect()
    assert {len(r.v) for r in got} == {1500}
    assert all(r.v.numNonzeros() == (r.c is not None and r.c < 1500) for r in got)
