import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from dailyseries.operators import models as md
from dailyseries.operators.quality import ensure_numeric
from dailyseries.session import scratch_path
from dailyseries.sources import files as io


def test_missing_folder(spark):
    with pytest.raises(FileNotFoundError):
        io.scan_csv_folder(spark, "/nonexistent/folder/for/test")


def test_na_tokens_and_types(spark, tmp_path):
    p = tmp_path / "raw"
    p.mkdir()
    (p / "a.Csv").write_text("player_id,ht,score,name\n1,6'11'',NA,x\n2,1-Jun,2.5,null\n3,,n/a,#N/A\n",
                             encoding="latin-1")
    (p / "notes.txt").write_text("ignore me")
    ds = io.scan_csv_folder(spark, str(p))
    assert list(ds) == ["a"]
    df = ds["a"]
    assert dict(df.dtypes) == {"player_id": "bigint", "ht": "double", "score": "double", "name": "string"}
    rows = df.orderBy("player_id").collect()
    assert rows[0]["ht"] == pytest.approx(210.82) and rows[0]["score"] is None
    assert rows[1]["name"] is None and rows[2]["ht"] is None


def test_ensure_numeric():
    class D:  # schema-only contract, no job
        pass
    with pytest.raises(ValueError):
        from pyspark.sql import SparkSession
        s = SparkSession.getActiveSession()
        ensure_numeric(s.createDataFrame([(1, "a")], "a int, b string"))


def test_gbt_fit_score_save_load(spark):
    from dailyseries.plans import fixtures as fx
    from dailyseries.plans.pipeline import feature_pipeline
    from dailyseries.operators.metrics import roc_auc
    df, feats, y = feature_pipeline(fx.daily_weather(spark, SF0001, nulls=True), task="classification")
    model, rounds = md.train_gbt(df, feats, y, params={"max_depth": 3}, max_iter=8, patience=3)
    assert 1 <= rounds <= 8
    s = md.score(model, df)
    assert s.where((F.col("p") < 0) | (F.col("p") > 1)).count() == 0
    tr_auc = roc_auc(s.where("split = 'train'"), y, "p").first()["auc_score"]
    assert tr_auc > 0.5
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    from pyspark.ml import PipelineModel
    again = PipelineModel.load(path)
    a = md.score(again, df).select("p").collect()
    b = s.select("p").collect()
    assert a == b
    with pytest.raises(ValueError):
        md.score(None, df)


def test_param_mapping():
    m = md.spark_params({"learning_rate": 0.05, "num_leaves": 64, "max_depth": -1, "min_data_in_leaf": 20,
                         "feature_fraction": 0.8, "bagging_fraction": 0.6, "bagging_freq": 5})
    assert m == {"stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 20, "featureSubsetStrategy": "0.8",
                 "subsamplingRate": 0.6}
    assert len(md.grid_from(md.DEFAULT_GRID)) == 5184


def test_scale_conf_from_input_size(spark):
    from dailyseries.session import input_bytes, scale_conf
    paths = [f"{SF0001}/lineitem.parquet", f"{SF0001}/orders.parquet"]
    assert input_bytes(spark, paths) > 0
    conf = scale_conf(spark, paths, apply=False)
    cores = spark.sparkContext.defaultParallelism
    assert int(conf["spark.sql.shuffle.partitions"]) == 2 * cores  # tiny input: the core floor
    big = scale_conf(spark, paths, bytes_per_partition=1 << 10, apply=False)
    assert int(big["spark.sql.shuffle.partitions"]) > 2 * cores


def test_model_round_trip_and_error_before_training(spark, tmp_path):
    from dailyseries.operators import models as md
    with pytest.raises(ValueError, match="no trained model"):
        md.save_model(None, str(tmp_path / "m"))
    df = spark.createDataFrame([(float(i % 7), float(i), i % 2, "train") for i in range(60)],
                               "a double, b double, y int, split string")
    m = md.train_random_forest(df, ["a", "b"], "y", num_trees=3, max_depth=2)
    md.save_model(m, str(tmp_path / "m"))
    same = md.load_model(str(tmp_path / "m"))
    assert [r.p for r in md.score(m, df).collect()] == [r.p for r in md.score(same, df).collect()]


def test_parameters_are_mapped_or_reported(spark):
    from dailyseries.operators import models as md
    with pytest.raises(ValueError, match="unknown model parameter"):
        md.spark_params({"no_such": 1})
    with pytest.warns(UserWarning, match="reg_alpha"):
        assert md.spark_params({"reg_alpha": 1, "max_depth": 4}) == {"maxDepth": 4}
    space = {f"p{i}": list(range(20)) for i in range(12)}  # 20 ** 12 points, never listed
    draws = md.sample_params(space, 30)
    assert len({tuple(d.items()) for d in draws}) == 30 and draws == md.sample_params(space, 30)


def test_csv_quoted_newlines_and_booleans(spark, tmp_path):
    from dailyseries.sources.files import read_csv_typed
    (tmp_path / "x.csv").write_text('player_id,name,ok\n1,"a\nb",true\n2,c,FALSE\n3,d,\n')
    rows = read_csv_typed(spark, str(tmp_path / "x.csv")).orderBy("player_id").collect()
    assert [tuple(r) for r in rows] == [(1, "a\nb", True), (2, "c", False), (3, "d", None)]


def test_service_payload_is_keyed_by_place(spark, tmp_path):
    from dailyseries.sources.files import ingest_daily_payload
    for n, lat in enumerate((1.5, 2.5)):
        (tmp_path / f"{n}.json").write_text('{\n "latitude": %s,\n "longitude": 3.0,\n "timezone": "UTC",\n "daily": '
                                            '{"time": ["2020-01-01", "2020-01-02"],\n "rain_sum": [1.0, null]}\n}\n' % lat)
    rows = ingest_daily_payload(spark, str(tmp_path), [("rain_sum", "double")], multi_line=True).collect()
    assert len(rows) == 4 and len({r.series_key for r in rows}) == 2


def test_shared_folder_is_required_off_local_masters(spark, monkeypatch):
    from types import SimpleNamespace

    from dailyseries import session
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(fake)
