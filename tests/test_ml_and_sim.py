import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sensorlake import config as C
from sensorlake.ml.registry import Registry
from sensorlake.operators.calibrate import calibrate
from sensorlake.operators.faults import inject_faults, reading_grid
from sensorlake.operators.validate import with_reasons
from sensorlake.plans.infer import run_inference, store_predictions
from sensorlake.plans.monitor import run_monitoring
from sensorlake.plans.train import run_training
from sensorlake.sources.events import readings_raw

REASON_OF = {
    "missing_sensor_id": "Sensor ID is missing",
    "missing_timestamp": "Timestamp is missing",
    "missing_temperature": "Temperature is missing",
    "missing_humidity": "Humidity is missing",
    "temperature_out_of_range": "Temperature is out of range",
    "humidity_out_of_range": "Humidity is out of range",
}


@pytest.fixture(scope="module")
def grid(spark):
    return reading_grid(spark, per_sensor=600)


def test_grid_shape(grid):
    assert grid.count() == 1800
    row = grid.agg(F.min("temperature"), F.max("temperature"), F.min("humidity"), F.max("humidity")).first()
    assert 358 <= row[0] and row[1] <= 385 and 48.5 <= row[2] and row[3] <= 61.5


def test_pass_branch_registers_and_promotes(spark, grid, tmp_path):
    root = str(tmp_path / "reg")
    res = run_training(grid, registry_root=root, store_root=str(tmp_path / "stores"),
                       invalid_path=str(tmp_path / "invalid"))
    assert res.passed and res.version == 1 and res.metrics["validation_mae"] < C.MAX_VALIDATION_MAE
    reg = Registry(spark, root)
    assert reg.alias_version() == 1
    model = reg.load()
    pred = run_inference(grid, model, str(tmp_path / "pred"))
    assert pred.count() == 1800 - 3
    assert spark.read.option("header", True).csv(str(tmp_path / "pred")).columns == \
        ["timestamp", "temperature", "prediction"]
    store_predictions(pred, str(tmp_path / "pstore"), 1)
    store_predictions(pred, str(tmp_path / "pstore"), 1)
    assert spark.read.parquet(str(tmp_path / "pstore")).count() == 1797
    mon = run_monitoring(grid, model, registry_root=root)
    assert mon.metrics["monitoring_mae"] < 15 and reg.runs().count() == 2
    # stores are insert-or-ignore: a second run adds nothing
    n = spark.read.parquet(str(tmp_path / "stores/sensor_readings")).count()
    run_training(grid, registry_root=root, store_root=str(tmp_path / "stores"), dedup_first=True)
    assert spark.read.parquet(str(tmp_path / "stores/sensor_readings")).count() == n == 1800
    assert Registry(spark, root).alias_version() == 2


def test_fail_branch_keeps_no_version(spark, tmp_path):
    root = str(tmp_path / "reg")
    res = run_training(readings_raw(spark, SF_SMALL), registry_root=root)
    assert not res.passed and res.version is None
    assert res.sensors_without_target == 1          # the '' pseudo-sensor has < 13 rows at sf0.001
    assert res.quality["total_rows"] == 1000 and res.quality["valid_rows"] == 818
    assert set(res.test_metrics) == {"test_mse", "test_mae", "test_rmse", "test_r2"}
    assert Registry(spark, root).alias_version() is None
    with pytest.raises(LookupError):
        Registry(spark, root).load()


def test_fault_labels_match_reasons(spark, grid):
    faulty = inject_faults(grid, rate=0.3, seed=5)
    rows = with_reasons(faulty).collect()
    n_faulty = 0
    for r in rows:
        if not r["is_faulty"]:
            assert r["reasons"] == ""
            continue
        n_faulty += 1
        if r["fault_type"] == "missing_sensor_id" and r["sensor_id"] == "":
            assert r["reasons"] == ""     # '' passes validation
        else:
            assert r["reasons"] == REASON_OF[r["fault_type"]]
    assert 0.2 < n_faulty / len(rows) < 0.4


def test_calibrate_matches_statistics(spark, readings):
    vals = [(1, 371.0, 55.0), (2, 373.5, 54.0), (3, 369.0, 57.5), (4, 380.0, 50.0), (5, None, 52.0)]
    df = readings([(i, "A", "2024-01-01 00:00:00", t, h) for i, t, h in vals])
    r = calibrate(df, chunk_rows=2).first()
    ts = [t for _, t, _ in vals if t is not None]
    hs = [h for _, t, h in vals if t is not None]
    assert r["n_rows"] == 4 and r["enough_rows"]
    assert r["temp_std"] == pytest.approx(statistics.pstdev(ts))
    dt = [b - a for a, b in zip(ts, ts[1:])]
    assert r["temp_step"] == pytest.approx(min(statistics.pstdev(dt), statistics.pstdev(ts) * 0.1))
    mt, mh = statistics.fmean(ts), statistics.fmean(hs)
    cov = sum((a - mt) * (b - mh) for a, b in zip(ts, hs)) / len(ts)
    assert r["coupling"] == pytest.approx(max(-2.0, min(2.0, cov / statistics.pvariance(ts))))


def test_coefficients_equal_least_squares(spark, grid):
    import numpy as np
    from sensorlake.ml.model import coefficients, train_model
    from sensorlake.operators.features import add_features
    from sensorlake.operators.splits import label_chrono
    from sensorlake.schemas import FEATURE_COLUMNS
    lab = label_chrono(add_features(grid, with_seq=True))
    train = lab.filter(F.col("split") == "train")
    model = train_model(train)
    got = {r["term"]: r["coefficient"] for r in coefficients(spark, model).collect()}
    pdf = train.select(*FEATURE_COLUMNS, "target_temperature").toPandas()
    X = np.column_stack([pdf[c].to_numpy() for c in FEATURE_COLUMNS] + [np.ones(len(pdf))])
    beta, *_ = np.linalg.lstsq(X, pdf["target_temperature"].to_numpy(), rcond=None)
    for i, c in enumerate(FEATURE_COLUMNS):
        assert got[c] == pytest.approx(beta[i], rel=1e-6, abs=1e-6)
    assert got["intercept"] == pytest.approx(beta[-1], rel=1e-6, abs=1e-5)


def test_champion_eval_equals_pandas(spark, grid):
    import numpy as np
    from sensorlake.ml.model import predict, train_model
    from sensorlake.operators.features import add_features
    from sensorlake.operators.splits import label_chrono, label_reference_current
    from sensorlake.plans.monitor import evaluate_on
    lab = label_chrono(add_features(grid, with_seq=True))
    model = train_model(lab.filter(F.col("split") == "train"))
    ref = label_reference_current(grid)
    m = evaluate_on(ref, model, "reference").first()
    part = ref.filter(F.col("slice") == "reference").drop("slice", "row_number", "total_rows")
    feats = add_features(part).dropna(subset=["temperature_change", "target_temperature"])
    p = predict(model, feats).select("prediction", "target_temperature").toPandas()
    e = p["prediction"].to_numpy() - p["target_temperature"].to_numpy()
    assert m["mae"] == pytest.approx(np.abs(e).mean()) and m["rmse"] == pytest.approx(np.sqrt((e * e).mean()))
    assert m["n_rows"] == len(p)


def test_grid_search_equals_sparks_fits(spark):
    """Every pair solved from one aggregation against Spark's own estimator."""
    from pyspark.ml.regression import LinearRegression
    from sensorlake.ml.model import assembler
    from sensorlake.ml.search import grid_search, moments, solve
    from sensorlake.schemas import FEATURE_COLUMNS
    u = [F.rand(i) for i in range(6)]
    rows = spark.range(800).select(
        (350 + 40 * u[0]).alias("temperature"), (50 + 10 * u[1] + 5 * u[0]).alias("humidity"),
        (u[2] - 0.5 + u[0]).alias("temperature_change"), (350 + 35 * u[0] + 5 * u[3]).alias("rolling_avg_temperature"),
        F.when(u[5] < 0.7, "train").otherwise("validation").alias("split"), u[4].alias("_e"))
    rows = rows.select("*", (0.6 * F.col("temperature") + 0.3 * F.col("humidity") - 2 * F.col("temperature_change")
                             + 6 * F.col("_e")).alias("target_temperature")).cache()
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'validation'")
    grid_r, grid_e = (0.0, 0.01, 0.5, 3.0), (0.0, 0.3, 1.0)
    got = {(r.reg_param, r.elastic_net_param): r for r in grid_search(rows, grid_r, grid_e).collect()}
    assert len(got) == 12
    m, vec = moments(train), assembler()
    for reg in grid_r:
        for en in grid_e:
            lr = LinearRegression(labelCol="target_temperature", regParam=reg, elasticNetParam=en, tol=1e-14, maxIter=2000)
            fit = lr.fit(vec.transform(train))
            weights, intercept = solve(m, reg, en)
            assert max(abs(a - b) for a, b in zip(weights, fit.coefficients.toArray())) < 1e-6, (reg, en)
            assert abs(intercept - fit.intercept) < 1e-4
            ev = fit.evaluate(vec.transform(test))
            r = got[reg, en]
            for mine, theirs in ((r.mse, ev.meanSquaredError), (r.mae, ev.meanAbsoluteError), (r.rmse, ev.rootMeanSquaredError),
                                 (r.r2, ev.r2)):
                assert abs(mine - theirs) < 1e-6, (reg, en)
    # a constant feature, a constant target, no rows
    flat = rows.withColumn("humidity", F.lit(50.0))
    weights, _ = solve(moments(flat.filter("split = 'train'")), 0.1, 0.5)
    assert weights[FEATURE_COLUMNS.index("humidity")] == 0 and abs(weights[0]) > 0
    weights, intercept = solve(moments(rows.withColumn("target_temperature", F.lit(7.0))), 0.1, 0.5)
    assert not weights.any() and intercept == 7.0
    assert [r.mae for r in grid_search(rows.limit(0), (0.0,), (0.0,)).collect()] == [None]
