"""The block path for hot groups must give what the plain window gives."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkkit.functions.scale import exact_quantiles
from sparkkit.operators import correlate, relational, sequence
from sparkkit.plans import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """One series holds most rows; keys include a null; values have ties."""
    rng = np.random.default_rng(3)
    rows = [("hot", i, float(rng.integers(0, 9)), float(rng.integers(0, 5))) for i in range(200)]
    rows += [("small", i, float(rng.integers(0, 9)), float(i)) for i in range(5)] + [(None, i, 1.0 * i, 2.0) for i in range(6)]
    return spark.createDataFrame(rows, "k string, i long, v double, w double").repartition(7).persist()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def both(f):
    plain, blocks = rows(f(10**9)), rows(f(7))
    assert plain == blocks
    return plain


def test_position(skewed):
    out = both(lambda hot: ordered.with_position(skewed, ["k"], ["i"], hot=hot).select("k", "i", "position"))
    assert all(i == p for _, i, p in out)


def test_position_without_groups(skewed):
    both(lambda hot: ordered.with_position(skewed, [], ["k", "i"], hot=hot).select("k", "i", "position"))


def test_running_sum(skewed):
    both(lambda hot: ordered.running_sum(skewed, ["k"], ["i"], {"s": F.col("v")}, hot=hot).select("k", "i", "s"))


def test_average_rank(skewed):
    out = both(lambda hot: ordered.average_rank(skewed, ["k"], "v", hot=hot).select("k", "i", "v", "rank"))
    pdf = pd.DataFrame(out, columns=["k", "i", "v", "rank"])
    assert (pdf.groupby("k", dropna=False)["v"].rank() == pdf["rank"]).all()


def test_lags_and_frames(skewed):
    both(lambda hot: sequence.add_lags(skewed, ["k"], ["i"], ["v"], 3, 3, hot=hot))
    both(lambda hot: sequence.add_lags(skewed, ["k"], ["i"], ["v"], 2, 1, dropna=False, hot=hot))
    both(lambda hot: sequence.difference(skewed, ["k"], ["i"], "v", [1, 4], hot=hot).select("k", "i", "diff"))
    both(lambda hot: sequence.sequence_window(skewed, ["k"], ["i"], ["v"], 4, hot=hot).select("k", "i", F.col("sequence").cast("string")))
    both(lambda hot: sequence.neighbour_context(skewed, "k", "i", "v", 2, 1, hot=hot))


def test_undifference_inverts_difference(spark, skewed):
    base = skewed.filter("k is not null").select("k", "i", "v")
    for lags in ([1], [2], [1, 3], [2, 5]):
        small = base.filter("i < 40")
        diffs = sequence.difference(small, ["k"], ["i"], "v", lags)
        seeds = small.join(diffs, ["k", "i"], "left_anti").select("k", "i", F.col("v").alias("seed"))
        joined = diffs.drop("v").unionByName(seeds, allowMissingColumns=True)
        for hot in (10**9, 7):
            back = sequence.undifference(joined, ["k"], ["i"], "diff", "seed", lags, hot=hot).select("k", "i", "y")
            got, want = rows(back), rows(small.select("k", "i", "v"))
            assert [r[:2] for r in got] == [r[:2] for r in want]
            assert np.allclose([r[2] for r in got], [r[2] for r in want]), (lags, hot)


def test_exact_quantiles(skewed):
    p = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    plain = exact_quantiles(skewed, ["v", "w"], p)
    blocks = exact_quantiles(skewed, ["v", "w"], p, hot=7)
    assert np.allclose(plain["v"], blocks["v"]) and np.allclose(plain["w"], blocks["w"])


def brute_tau(x, y):
    s = n1 = n2 = n0 = 0
    for i in range(len(x)):
        for j in range(i):
            s += np.sign(x[i] - x[j]) * np.sign(y[i] - y[j])
            n1 += x[i] == x[j]
            n2 += y[i] == y[j]
            n0 += 1
    return s / np.sqrt((n0 - n1) * (n0 - n2))


def test_kendall_blocks(skewed):
    pdf = skewed.filter("k = 'hot'").toPandas()
    want = brute_tau(pdf["v"].to_numpy(), pdf["w"].to_numpy())
    for rows_per_block, blocks, hot in ((10**6, 1000, 10**9), (10, 1000, 10**9), (10, 4, 20)):
        out = correlate.kendall(skewed, "v", "w", ["k"], rows_per_block, blocks, hot)
        got = {r["k"]: r["correlation"] for r in out.collect()}
        assert got["hot"] == pytest.approx(want)
        assert got[None] is None  # constant series
    alone = correlate.kendall(skewed.filter("k = 'hot'"), "v", "w", (), 16).first()["correlation"]
    assert alone == pytest.approx(want)


def test_spearman_blocks(skewed):
    plain = {r["k"]: r["correlation"] for r in correlate.spearman(skewed, "v", "w", ["k"]).collect()}
    blocks = {r["k"]: r["correlation"] for r in correlate.spearman(skewed, "v", "w", ["k"], hot=9).collect()}
    assert plain.keys() == blocks.keys()
    assert all(plain[k] == pytest.approx(blocks[k]) for k in plain)


def test_concat_series_parts(skewed):
    whole = {r["k"]: r["series"] for r in relational.concat_series(skewed, ["k"], ["i"], "i").collect()}
    parts = relational.concat_series(skewed, ["k"], ["i"], "i", part_rows=50).orderBy("k", "part").collect()
    assert ";".join(r["series"] for r in parts if r["k"] == "hot") == whole["hot"]
    assert len(parts) > len(whole)


def test_pivot_refuses_duplicates(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0)], "k string, d string, v double")
    got = {r["k"]: (r["x"], r["y"]) for r in relational.pivot(df, "k", "d", "v").collect()}
    assert got == {"a": (1.0, 2.0), "b": (3.0, None)}
    with pytest.raises(Exception, match="several rows"):
        relational.pivot(df.union(df), "k", "d", "v").collect()


def test_running_sum_is_null_until_the_first_value_on_both_paths(spark):
    from sparkkit.plans.ordered import running_sum

    df = spark.createDataFrame([(1, None), (2, None), (3, 5), (4, 1), (5, None)], "k int, v int")
    found = [[r["s"] for r in running_sum(df, [], ["k"], {"s": F.col("v")}, hot=hot).orderBy("k").collect()] for hot in (100, 1)]
    assert found == [[None, None, 5, 6, 6]] * 2


def test_rank_matrix_equals_the_pairs(spark):
    from sparkkit.operators.correlate import correlate, correlation_matrix

    df = spark.createDataFrame([(1.0, 4.0, 2.0), (2.0, None, 1.0), (3.0, 1.0, 9.0), (None, 2.0, 3.0), (5.0, 2.0, 4.0), (6.0, 0.0, None)], "a double, b double, c double")
    for method in ("spearman", "kendall"):
        got = {(r["a"], r["b"]): r["correlation"] for r in correlation_matrix(df, ["a", "b", "c"], method).collect()}
        assert len(got) == 9
        for x, y in got:
            want = correlate(df.dropna(subset=[x, y]).select(F.col(x).alias("x"), F.col(y).alias("y")), "x", "y", [], method).first()["correlation"]
            assert abs(got[x, y] - want) < 1e-9


def test_permutations_move_values_over_the_whole_table(spark):
    from sparkkit.operators import importance, split

    df = spark.range(3000).selectExpr("id", "cast(id as double) a", "cast(id % 7 as double) b").repartition(6)
    copies = importance.shuffled_copies(df, "id", ["a", "b"], 2).toPandas()
    for (feature, _), part in copies.groupby(["__feature", "__repeat"]):
        assert len(part) == 3000 and sorted(part["id"]) == list(range(3000))
        assert sorted(part["a"]) == list(range(3000)) and (part["a"] == part["id"]).all() == (feature != "a")
    moved = split.shuffled_column(df, "id", "a", 1, "other").toPandas()
    assert sorted(moved["other"]) == list(range(3000)) and (moved["other"] != moved["id"]).mean() > 0.9


def test_theil_sen_on_one_feature(spark):
    from sparkkit.operators import estimators

    df = spark.range(500).selectExpr("cast(id as double) x", "cast(if(id % 10 = 0, 1000, 3 * id + 2) as double) y")
    model = estimators.fit_estimator("TheilSenRegressor", df, ["x"], "y")
    got = {r["x"]: r["prediction"] for r in model.predict(df).filter("x in (1, 101)").collect()}
    assert abs(got[101.0] - got[1.0] - 300) < 15
