"""Encoders, metrics and validation splits over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import encode as enc
from ..functions.spec import Feature
from ..operators import metrics as met
from ..operators import split as sp
from ..operators.preprocess import Preprocessor
from . import query
from .helpers import r, sr

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("E1", "SELECT o_orderkey, " + ", ".join(
    f"(o_orderpriority = '{p}')::INT AS \"o_orderpriority_{p}\"" for p in PRIORITIES) + " FROM orders")
def one_hot(t):
    return enc.one_hot(t.orders.select("o_orderkey", "o_orderpriority"), enc.fit_categories(t.orders, ["o_orderpriority"]))


SQL_CHARS = "list_filter(string_split(p_name, ''), lambda c: c <> '')"
SQL_HASH = ", ".join(
    f"list_sum(list_transform({SQL_CHARS}, lambda c: CASE WHEN ('0x' || substr(md5(c), 1, 8))::BIGINT % 4 = {j} THEN "
    f"CASE WHEN ('0x' || substr(md5(c), 9, 8))::BIGINT % 2 = 0 THEN 1 ELSE -1 END ELSE 0 END))::DOUBLE AS p_name_{j}" for j in range(4))


@query("E2", f"SELECT p_partkey, {SQL_HASH} FROM part")
def hash_encode(t):
    return enc.hash_encode(t.part.select("p_partkey", "p_name"), "p_name", 4).drop("p_name")


SQL_TERMS = r"""terms AS (SELECT doc_id, term, count(*)::BIGINT AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents) GROUP BY 1, 2)"""


@query("E3", f"WITH {SQL_TERMS} SELECT * FROM terms")
def count_vectorize(t):
    return enc.count_vectorize(t.documents, "doc_id", "text")


@query("E3", r"""
WITH w AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS x FROM conversations),
g AS (SELECT conv_id, turn, unnest(x) AS term FROM w UNION ALL
  SELECT conv_id, turn, x[i] || ' ' || x[i + 1] FROM w, LATERAL (SELECT unnest(generate_series(1, len(x) - 1)) AS i)),
c AS (SELECT conv_id || '-' || turn AS key, term, count(*)::BIGINT AS n FROM g GROUP BY 1, 2)
SELECT * FROM c WHERE term IN (SELECT term FROM c GROUP BY 1 HAVING count(*) >= 3)""")
def count_vectorize_ngrams(t):
    rows = t.conversations.select(F.concat_ws("-", "conv_id", "turn").alias("key"), "text")
    return enc.count_vectorize(rows, "key", "text", min_df=3, ngram_range=(1, 2)).select("key", "term", "n")


@query("E4", f"""
WITH {SQL_TERMS}, v AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM terms GROUP BY 1),
w AS (SELECT doc_id, term, n * idf AS w FROM terms JOIN v USING (term)), s AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1)
SELECT doc_id, term, {sr('w / norm')} AS weight FROM w JOIN s USING (doc_id)""")
def tf_idf(t):
    return enc.tf_idf(t.documents, "doc_id", "text").withColumn("weight", r("weight"))


@query("E5", "SELECT p_partkey, " + ", ".join(
    f"contains(p_type, chr({o}))::INT AS p_type_{o}" for o in sorted({ord(c) for c in "ECONOMYSTANDARDPROMOLARGESMALLMEDIUM"})) + " FROM part")
def char_one_hot(t):
    chars = enc.fit_characters(t.part, "p_type")
    wanted = sorted(set("ECONOMYSTANDARDPROMOLARGESMALLMEDIUM"))
    done = enc.char_one_hot(t.part.select("p_partkey", "p_type"), "p_type", chars).drop("p_type")
    return enc.align_columns(done, [f"p_type_{ord(c)}" for c in wanted], ["p_partkey"])


@query("E6", """
SELECT o_orderkey, (o_orderstatus = 'F')::INT AS "o_orderstatus_F", 0 AS "o_orderstatus_X", (o_orderstatus = 'O')::INT AS "o_orderstatus_O" FROM orders""")
def align_columns(t):
    wide = enc.one_hot(t.orders.select("o_orderkey", "o_orderstatus"), enc.fit_categories(t.orders, ["o_orderstatus"]))
    return enc.align_columns(wide, ["o_orderstatus_F", "o_orderstatus_X", "o_orderstatus_O"], ["o_orderkey"])


@query("E7", "SELECT l_orderkey, l_linenumber, md5(l_returnflag) AS code FROM lineitem")
def encode_distinct(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return enc.encode_distinct(rows, "l_returnflag", lambda d: d.withColumn("code", F.md5("l_returnflag"))).drop("l_returnflag")


DOC_SPEC = [
    Feature("doc_id", "identifier", "int"),
    Feature("lang", strategy="one hot encoding", dtype="str"),
    Feature("source", strategy="hashing", dtype="str", args={"n_features": 4}),
    Feature("text", strategy="tf_idf", dtype="str", args={"max_features": 20}),
    Feature("n_chars", strategy="scaling"),
]


@query("E8")
def preprocessor(t):
    model = Preprocessor(DOC_SPEC, scaler="standard").fit(t.documents)
    out = model.transform(t.documents)
    return out.select("doc_id", *[r(F.col(f"`{c}`")).alias(c) for c in model.columns])


# ---- metrics -------------------------------------------------------------------------------


def _classified(t):
    """Return flag predicted from quantity and discount by a fixed rule."""
    guess = F.when(F.col("l_quantity") < 17, "A").when(F.col("l_discount") > 0.05, "N").otherwise("R")
    return t.lineitem.select("l_orderkey", F.col("l_returnflag").alias("y"), guess.alias("p"), (F.col("l_orderkey") % 4).alias("fold"))


SQL_CLASSIFIED = """c AS (SELECT l_orderkey, l_returnflag AS y, CASE WHEN l_quantity < 17 THEN 'A' WHEN l_discount > 0.05 THEN 'N' ELSE 'R' END AS p,
  l_orderkey % 4 AS fold FROM lineitem)"""


def _class_sql(by: str = "") -> str:
    comma = f"{by}," if by else ""
    using = f"({by}, class)" if by else "(class)"
    return f"""t1 AS (SELECT {comma} y AS class, count(*) AS support, sum((y = p)::INT) AS tp FROM c GROUP BY ALL),
t2 AS (SELECT {comma} p AS class, count(*) AS predicted FROM c GROUP BY ALL),
k AS (SELECT {comma} class, support, coalesce(tp / nullif(predicted, 0), 0) AS prec, tp / support AS rec, tp FROM t1 LEFT JOIN t2 USING {using}),
m AS (SELECT *, coalesce(2 * prec * rec / nullif(prec + rec, 0), 0) AS f FROM k)"""


CLASS_COLUMNS = ("accuracy", "precision", "recall", "fscore")


@query("H1", f"""WITH {SQL_CLASSIFIED}, {_class_sql()}
SELECT 'model' AS model_name, class, NULL::DOUBLE AS accuracy, {sr('prec')} AS precision, {sr('rec')} AS recall, {sr('f')} AS fscore, support::BIGINT AS support FROM m
UNION ALL SELECT 'model', 'overall', {sr('sum(tp) / sum(support)')}, NULL, NULL, NULL, sum(support)::BIGINT FROM m""")
def classifier_metrics(t):
    done = met.classifier_metrics(_classified(t), "y", "p")
    return done.select("model_name", "class", *[r(c).alias(c) for c in CLASS_COLUMNS], "support")


@query("H1", f"""WITH {SQL_CLASSIFIED}, {_class_sql()}
SELECT 'model' AS model_name, 'overall' AS class, {sr('sum(tp) / sum(support)')} AS accuracy, {sr('sum(prec * support) / sum(support)')} AS precision,
  {sr('sum(rec * support) / sum(support)')} AS recall, {sr('sum(f * support) / sum(support)')} AS fscore, sum(support)::BIGINT AS support FROM m""")
def classifier_metrics_weighted(t):
    done = met.classifier_metrics(_classified(t), "y", "p", average="weighted")
    return done.select("model_name", "class", *[r(c).alias(c) for c in CLASS_COLUMNS], "support")


def _regressed(t):
    """Price predicted from the quantity by a fixed rule."""
    return t.lineitem.select("l_orderkey", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500 + 1000).alias("p"),
                             (F.col("l_orderkey") % 4).alias("fold"))


SQL_REGRESSED = """g AS (SELECT l_orderkey, l_extendedprice AS y, l_quantity * 1500 + 1000 AS p, l_orderkey % 4 AS fold FROM lineitem)"""
SQL_REGRESSION = """1 - avg((y-p)*(y-p)) / var_pop(y) AS r2_score, avg((y-p)*(y-p)) / 1e6 AS mean_squared_error, avg(abs(y-p)) AS mean_absolute_error,
  median(abs(y-p)) AS median_absolute_error, 1 - var_pop(y-p) / var_pop(y) AS explained_variance_score"""


def _regression_columns(df, suffixes=("",)):
    """Squared errors in millions, so that rounding has digits to spare."""
    return [
        (r(F.col(c + s) / 1e6) if c == "mean_squared_error" else r(c + s)).alias(c + s) for s in suffixes for c in met.REGRESSION]


@query("H2", f"WITH {SQL_REGRESSED}, m AS (SELECT {SQL_REGRESSION} FROM g) SELECT 'model' AS model_name, "
       + ", ".join(f"{sr(c)} AS {c}" for c in met.REGRESSION) + " FROM m")
def regressor_metrics(t):
    done = met.regressor_metrics(_regressed(t), "y", "p")
    return done.select("model_name", *_regression_columns(done))


@query("H3", f"""WITH {SQL_CLASSIFIED}, {_class_sql('fold')},
a AS (SELECT fold, class, NULL::DOUBLE AS accuracy, prec AS precision, rec AS recall, f AS fscore FROM m
  UNION ALL SELECT fold, 'overall', sum(tp) / sum(support), NULL, NULL, NULL FROM m GROUP BY 1)
SELECT 'model' AS model_name, class, """ + ", ".join(
    f"{sr(f'avg({c})')} AS {c}, {sr(f'stddev_pop({c})')} AS {c}_std" for c in CLASS_COLUMNS) + " FROM a GROUP BY class")
def cv_classifier_metrics(t):
    done = met.cv_classifier_metrics(_classified(t), "y", "p", "fold")
    return done.select("model_name", "class", *[r(c + s).alias(c + s) for c in CLASS_COLUMNS for s in ("", "_std")])


@query("H4", f"WITH {SQL_REGRESSED}, m AS (SELECT fold, {SQL_REGRESSION} FROM g GROUP BY 1) SELECT 'model' AS model_name, "
       + ", ".join(f"{sr(f'avg({c})')} AS {c}, {sr(f'stddev_pop({c})')} AS {c}_std" for c in met.REGRESSION) + " FROM m")
def cv_regressor_metrics(t):
    done = met.cv_regressor_metrics(_regressed(t), "y", "p", "fold")
    return done.select("model_name", *_regression_columns(done, ("", "_std")))


@query("H5", f"""WITH {SQL_CLASSIFIED}, l AS (SELECT unnest(['A', 'N', 'R']) AS v)
SELECT 'model' AS model_name, a.v AS true_label, b.v AS pred_label, (SELECT count(*) FROM c WHERE y = a.v AND p = b.v)::BIGINT AS count FROM l a, l b""")
def confusion_matrix(t):
    return met.confusion_matrix(_classified(t), "y", "p")


def _steps(t):
    return t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y0"), (F.col("l_quantity") > 25).cast("int").alias("p0"),
        (F.col("l_linestatus") == "F").cast("int").alias("y1"), (F.col("l_discount") > 0.05).cast("int").alias("p1"))


@query("H6", """
WITH s AS (SELECT 'step 0' AS step, l_returnflag = 'R' AS y, l_quantity > 25 AS p FROM lineitem
  UNION ALL SELECT 'step 1', l_linestatus = 'F', l_discount > 0.05 FROM lineitem)
SELECT 'model' AS model_name, step, count(*) FILTER (NOT y AND NOT p)::BIGINT AS true_negative, count(*) FILTER (NOT y AND p)::BIGINT AS false_positive,
  count(*) FILTER (y AND NOT p)::BIGINT AS false_negative, count(*) FILTER (y AND p)::BIGINT AS true_positive FROM s GROUP BY step""")
def step_confusion(t):
    return met.step_confusion(_steps(t), {"step 0": ("y0", "p0"), "step 1": ("y1", "p1")})


@query("H8", f"""WITH {SQL_CLASSIFIED}, {SQL_REGRESSED}
SELECT 'model' AS model_name, 'accuracy' AS score_result, {sr('avg((y = p)::INT)')} AS score FROM c
UNION ALL SELECT 'model', 'r2', {sr('1 - avg((y-p)*(y-p)) / var_pop(y)')} FROM g""")
def overall_score(t):
    a = met.overall_score(_classified(t), "y", "p", "classifier")
    return a.unionByName(met.overall_score(_regressed(t), "y", "p", "regressor")).withColumn("score", r("score"))


@query("H9", f"""
SELECT l_linestatus, {sr("avg(-CASE WHEN l_returnflag = 'R' THEN ln(greatest(l_discount * 5, 1e-15)) ELSE ln(greatest(1 - l_discount * 5, 1e-15)) END)")} AS log_loss,
  {sr('avg(abs(l_quantity - 30 * l_discount))')} AS mae,
  {sr("2 * count(*) FILTER (l_returnflag = 'R' AND l_quantity > 25) / (count(*) FILTER (l_returnflag = 'R') + count(*) FILTER (l_quantity > 25))")} AS f1
FROM lineitem GROUP BY 1""")
def scorers(t):
    y, p = (F.col("l_returnflag") == "R").cast("int"), (F.col("l_quantity") > 25).cast("int")
    done = t.lineitem.groupBy("l_linestatus").agg(
        met.log_loss(y, F.col("l_discount") * 5).alias("log_loss"),
        met.mean_absolute_error(F.col("l_quantity"), 30 * F.col("l_discount")).alias("mae"), met.f1_score(y, p).alias("f1"))
    return done.select("l_linestatus", r("log_loss").alias("log_loss"), r("mae").alias("mae"), r("f1").alias("f1"))


# ---- splits --------------------------------------------------------------------------------

SQL_U = "('0x' || substr(md5({key} || '|42'), 1, 8))::BIGINT / 4294967296.0"


@query("N5", f"SELECT o_orderkey, ({SQL_U.format(key='o_orderkey')} < 0.33)::INT AS is_test FROM orders")
def holdout_split(t):
    done = sp.holdout_split(t.orders.select("o_orderkey"), "o_orderkey")
    return done.withColumn("is_test", F.col("is_test").cast("int"))


@query("N6", f"""
SELECT o_orderkey, o_orderstatus, ((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {SQL_U.format(key='o_orderkey')}, o_orderkey) - 1) % 5)::BIGINT AS fold FROM orders""")
def kfold_stratified(t):
    return sp.kfold(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", 5, "o_orderstatus")


@query("N6", "SELECT o_orderkey, (ntile(7) OVER (ORDER BY o_orderkey) - 1)::BIGINT AS fold FROM orders")
def kfold_contiguous(t):
    return sp.kfold(t.orders.select("o_orderkey"), "o_orderkey", 7)


@query("N7", """
WITH x AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p, count(*) OVER () AS n FROM orders),
f AS (SELECT *, n // 5 AS size, unnest([0, 1, 2, 3]) AS fold FROM x), s AS (SELECT *, n - (4 - fold) * size AS start FROM f)
SELECT o_orderkey, fold::BIGINT AS fold, CASE WHEN p < start THEN 'train' ELSE 'test' END AS role FROM s
WHERE p < start + size AND p >= greatest(start - 4000, 0)""")
def time_series_split(t):
    return sp.time_series_split(t.orders.select("o_orderkey"), "o_orderkey", 4, 4000)


@query("N2", """
WITH x AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS prio, o_orderstatus, o_custkey::VARCHAR AS cust FROM orders)
SELECT 'orders' AS model_name, 0::BIGINT AS sort_order, 'cust' AS feature, 'identifier' AS var_type, 'int' AS data_type, 'none' AS strategy, '' AS strategy_args,
  0::BIGINT AS nulls, 0::BIGINT AS cast_failures, count(DISTINCT cust)::BIGINT AS distinct_values FROM x
UNION ALL SELECT 'orders', 1, 'prio', 'feature', 'float', 'hashing', 'n_features=4', count(*) - count(prio), count(prio), count(DISTINCT prio) FROM x
UNION ALL SELECT 'orders', 2, 'o_orderstatus', 'target', 'str', 'none', '', 0, 0, count(DISTINCT o_orderstatus) FROM x""")
def profile_features(t):
    rows = t.orders.select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("prio"), "o_orderstatus",
                           F.col("o_custkey").cast("string").alias("cust"))
    spec = [Feature("cust", "identifier", "int"), Feature("prio", "feature", "float", "hashing", {"n_features": 4}),
            Feature("o_orderstatus", "target", "str")]
    done = sp.profile_features(rows, spec, "orders")
    return done.withColumn("cast_failures", F.col("cast_failures").cast("bigint"))
