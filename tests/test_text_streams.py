"""Entities on awkward texts; streams against batches; registered queries against their oracles."""

import os
import sys

import pytest

from sparkkit import queries as Q
from sparkkit.operators import entities as ent
from sparkkit.operators.linear import fit_linear
from sparkkit.streaming import operators as st

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def spans(df):
    return sorted(tuple(r) for r in df.collect())


def test_dictionary_offsets_count_code_points(spark):
    texts = spark.createDataFrame([(1, "Élan 😀 C++ et New York, new york"), (2, "New Yorker"), (3, None)], "k int, t string")
    phrases = spark.createDataFrame([("New York", "GPE", "Places"), ("C++", "LANG", "Languages"), ("Élan", "X", "x")], "phrase string, type string, description string")
    got = spans(ent.gazetteer_entities(texts, "k", "t", phrases).select("key", "start", "end", "type", "entity"))
    assert got == [(1, 0, 4, "X", "Élan"), (1, 7, 10, "LANG", "C++"), (1, 14, 22, "GPE", "New York"), (1, 24, 32, "GPE", "new york")]


def test_patterns(spark):
    texts = spark.createDataFrame([(1, "mail a.b@c.org on 2024-05-06, pay $1,200.50 😀 7")], "k int, t string")
    got = spans(ent.extract_entities(texts, "k", "t").select("start", "end", "type", "entity"))
    assert got == [(5, 14, "EMAIL", "a.b@c.org"), (18, 28, "DATE", "2024-05-06"), (34, 43, "MONEY", "$1,200.50"), (46, 47, "CARDINAL", "7")]


def test_alignment_quotes_regex_characters_and_takes_types_in_turn(spark):
    rows = [("a.b a.b axb (x) a.b", "a.b", "P", 0), ("a.b a.b axb (x) a.b", "a.b", "Q", 1), ("plain", "", "", 0)]
    df = spark.createDataFrame(rows, "text string, entity string, entity_type string, o int")
    got = spans(ent.align_annotations(df, order="o").select("start", "end", "type"))
    assert got == [(0, 3, "P"), (4, 7, "Q"), (16, 19, "Q")]


def test_contained_and_equal_spans(spark):
    df = spark.createDataFrame([(1, 0, 10, "a"), (1, 2, 5, "b"), (1, 0, 10, "c"), (1, 8, 12, "d"), (2, 2, 5, "b")], "key int, start int, end int, type string")
    assert [(r[0], r[1], r[2]) for r in spans(ent.drop_contained_spans(df))] == [(1, 0, 10), (1, 8, 12), (2, 2, 5)]


def test_partial_fit_equals_batch_whatever_the_batches(spark, tmp_path):
    df = spark.range(400).selectExpr("id", "cast(id % 17 as double) a", "cast(id % 5 as double) b", "cast(3 * (id % 17) - (id % 5) + 1 as double) y")
    df.repartition(6).write.parquet(str(tmp_path / "in"))
    state = st.PartialFit(spark, str(tmp_path / "state"), ["a", "b"], "y")
    state.run(st.read_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1), str(tmp_path / "ck"))
    whole = fit_linear(df, ["a", "b"], ["y"])
    assert state.model().coef[:, 0] == pytest.approx(whole.coef[:, 0])
    # a batch that arrives twice does not count twice
    first = spark.read.parquet(str(tmp_path / "in")).limit(50)
    state.update(first, 0)
    state.update(first, 0)
    assert len(os.listdir(tmp_path / "state")) >= 6


@pytest.mark.parametrize("name", ["market_basket", "pack_features", "add_lags", "classifier_metrics", "kfold_stratified", "ridge_cv", "holiday_terms", "windowed_stats", "dbscan"])
def test_query_matches_its_oracle(spark, name):
    import check

    folder = "/root/testdata/sf0.001"
    q = Q.load()[name]
    count, problem = check.compare(q.run(spark, folder), check.database(folder), q.sql)
    assert problem is None and count > 0


def test_every_query_has_a_coverage_entry():
    assert all(q.operator for q in Q.load().values())


def test_sessions_merge_and_close_behind_the_watermark(spark, tmp_path):
    rows = [("a", 0), ("a", 50), ("a", 200), ("b", 10), ("a", 100), ("b", 400), ("b", 1000)]
    df = spark.createDataFrame(rows, "k string, s long").selectExpr("k", "timestamp_seconds(s) ts", "cast(s as double) v")
    want = {("a", 0, 160, 3), ("a", 200, 260, 1), ("b", 10, 70, 1), ("b", 400, 460, 1), ("b", 1000, 1060, 1)}
    shown = lambda d: {tuple(r) for r in d.selectExpr("k", "unix_seconds(start)", "unix_seconds(end)", "n").collect()}
    assert shown(st.session_stats(df, "ts", "v", "60 seconds", ["k"])) == want
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    df.limit(0).write.parquet(str(tmp_path / "none"))
    stats = st.session_stats(st.read_stream(spark, str(tmp_path / "in"), df.schema), "ts", "v", "60 seconds", ["k"], "100 seconds")
    st.write_stream(stats, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    # the watermark ends at 900: the last session stays open
    assert shown(spark.read.schema(stats.schema).parquet(str(tmp_path / "out"))) == {w for w in want if w[2] <= 900}
