"""Edge values of the column expressions."""

import pytest
from pyspark.sql import functions as F

from sparkkit.functions import encode, nulls, parse, scale
from sparkkit.functions.spec import Feature
from sparkkit.operators import metrics
from sparkkit.operators.preprocess import Preprocessor


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.select("i", expr.alias("o")).orderBy("i").select("o").collect()]


def test_parse_number(spark):
    texts = ["", "NA", "1,234.50", "1.234,50", "1 234,5", "4,294,967,295.00", "4.294.967.295,000", "12", "-3,5", None]
    want = [None, None, 1234.5, 1234.5, 1234.5, 4294967295.0, 4294967295.0, 12.0, -3.5, None]
    assert column(spark, texts, parse.parse_number("c")) == want


def test_parse_int(spark):
    texts = ["3.7", "4,294,967,295", "4 294", "x", ""]
    assert column(spark, texts, parse.parse_int("c")) == [37, 4294967295, 4294, None, None]
    assert column(spark, texts, parse.parse_int("c", strict=True)) == [None, 4294967295, 4294, None, None]


def test_pack_and_unpack(spark):
    df = spark.createDataFrame([("a", None, "c"), ("x", "y", None)], "p string, q string, r string")
    packed = df.select(parse.pack_features(["p", "q", "r"]).alias("s"))
    back = packed.select(*parse.unpack_features("s", ["p", "q", "r"]))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    with pytest.raises(Exception, match="expected 2 fields"):
        packed.select(*parse.unpack_features("s", ["p", "q"])).collect()


def test_serial_numbers(spark):
    assert column(spark, [45292.0, 45292.75], F.date_format(parse.serial_to_ts("c"), "yyyy-MM-dd HH:mm"), "double") == ["2024-01-01 00:00", "2024-01-01 18:00"]


def test_scalers_on_constant_and_null_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None)], "a double, b double")
    for name in ("standard", "minmax", "maxabs", "robust"):
        out = scale.scale(df, ["a", "b"], scale.fit_scaler(df, ["a", "b"], name)).collect()
        assert all(r["a"] in (0.0, 1.0) and r["b"] is None for r in out), name


def test_quantile_scaler_with_runs(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 0, 1, 2, 3, 9]], "a double")
    out = [r[0] for r in scale.scale(df, ["a"], scale.fit_scaler(df, ["a"], "quantile")).orderBy("a").collect()]
    assert out[0] == 0.0 and out[-1] == 1.0 and out == sorted(out)


def test_mode_takes_the_smallest_of_the_most_frequent(spark):
    df = spark.createDataFrame([(v,) for v in [5.0, 5.0, 2.0, 2.0, 9.0, None]], "a double")
    assert nulls.missing_values(df, ["a"], "mode") == {"a": 2.0}


def test_one_hot_of_unseen_values(spark):
    fit = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    later = spark.createDataFrame([("x",), ("z",), (None,)], "c string")
    out = encode.one_hot(later, encode.fit_categories(fit, ["c"])).collect()
    assert sorted(map(tuple, out)) == [(0, 0), (0, 0), (1, 0)]


def test_preprocessor_keeps_its_training_state(spark):
    spec = [Feature("c", dtype="str", strategy="one hot encoding"), Feature("t", dtype="str", strategy="tf_idf"), Feature("h", dtype="str", strategy="hashing", args={"n_features": 3}),
            Feature("s", dtype="str", strategy="text_similarity"), Feature("v", strategy="scaling"), Feature("w")]
    train = spark.createDataFrame([("a", "red fish", "k1", "ab", 1.0, 2.0), ("b", "blue fish", "k2", "bc", 3.0, None)], "c string, t string, h string, s string, v double, w double")
    model = Preprocessor(spec).fit(train)
    again = Preprocessor.from_json(model.to_json())
    later = spark.createDataFrame([("zz", "green bird", "k9", "xyz", 100.0, 1.0)], train.schema)
    row = again.transform(later).first()
    assert list(row.asDict()) == again.columns == model.columns
    assert row["c_a"] == row["c_b"] == 0.0 and row["v"] == 98.0
    assert again.transform(later, "features").first()["features"].size == len(model.columns)


def test_metrics_with_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "y string, p string")
    rows = {r["class"]: r for r in metrics.classifier_metrics(df, "y", "p").collect()}
    assert (rows["b"]["precision"], rows["b"]["recall"], rows["b"]["fscore"]) == (0.0, 0.0, 0.0)
    assert rows["overall"]["accuracy"] == pytest.approx(2 / 3)
    assert metrics.confusion_matrix(df, "y", "p").count() == 9


def test_regression_metrics_of_a_constant_target(spark):
    row = metrics.regressor_metrics(spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "y double, p double"), "y", "p").first()
    assert row["r2_score"] is None and row["median_absolute_error"] == 2.0
