"""Parsing, formatting, null handling and scalers over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import distance, nulls, parse, scale
from ..functions.spec import Feature
from ..plans.durable import scratch_folder
from ..sources import tables
from . import query
from .helpers import r, sr

SPEC = [
    Feature("l_orderkey", "identifier", "int"),
    Feature("l_linenumber", "feature", "int"),
    Feature("l_discount", "target", "float"),
    Feature("l_returnflag", "feature", "str"),
    Feature("l_linestatus", "excluded", "str"),
]
SPEC_COLUMNS = "l_orderkey, l_linenumber, l_discount, l_returnflag, l_linestatus"


@query("A1", f"""
SELECT r_name, n_name, count(*)::BIGINT AS customers FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def read_table(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("customers"))


@query("A2", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def write_table_roundtrip(t):
    path = scratch_folder(t.spark)
    schema = t.supplier.schema
    tables.write_table(t.supplier, f"{path}-csv", "csv")
    middle = tables.read_table(t.spark, f"{path}-csv", "csv", schema)
    tables.write_table(middle, f"{path}-json", "json")
    middle = tables.read_table(t.spark, f"{path}-json", "json", schema)
    tables.write_table(middle, f"{path}-orc", "orc")
    return tables.read_table(t.spark, f"{path}-orc", "orc")


@query("B1", """
SELECT o_orderkey, o_orderkey || '|' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END || '|' ||
  o_orderpriority AS packed FROM orders""")
def pack_features(t):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return t.orders.select("o_orderkey", parse.pack_features(["o_orderkey", status, "o_orderpriority"]).alias("packed"))


@query("B1", """
SELECT 'plain' AS variant, 'l_linenumber|l_returnflag' AS expression, count(*)::BIGINT AS n FROM lineitem
UNION ALL SELECT 'lags', 'l_orderkey|l_linenumber|l_returnflag', count(*) FROM lineitem
UNION ALL SELECT 'lag_target', 'l_orderkey|l_linenumber|l_discount|l_returnflag', count(*) FROM lineitem""")
def features_expression(t):
    variants = {"plain": {}, "lags": {"lags": True}, "lag_target": {"lags": True, "lag_target": True}}
    counted = t.lineitem.select(F.count(F.lit(1)).alias("n"))
    rows = [F.struct(F.lit(k).alias("variant"), F.lit("|".join(parse.features_expression(SPEC, **v))).alias("expression"))
            for k, v in variants.items()]
    return counted.select(F.inline(F.array(*rows)), "n")


@query("B2", "SELECT o_orderkey::VARCHAR AS k, nullif(o_orderstatus, 'P') AS status, o_orderpriority AS prio FROM orders")
def unpack_features(t):
    packed = pack_features(t)
    return packed.select(*parse.unpack_features("packed", ["k", "status", "prio"]))


TEXT_NUMBERS = """
SELECT l_orderkey, l_linenumber, (l_extendedprice * 100)::BIGINT AS cents, l_linenumber % 7 AS style FROM lineitem"""


def _number_texts(t):
    """Prices written in seven regional notations, made from every line item."""
    price = F.format_number(F.col("l_extendedprice"), 2)
    swapped = F.translate(price, ",.", ".,")
    spaced = F.translate(price, ",", " ")
    plain = F.translate(price, ",", "")
    style = F.col("l_linenumber") % 7
    text = (F.when(style == 0, price).when(style == 1, swapped).when(style == 2, spaced).when(style == 3, plain)
            .when(style == 4, F.translate(plain, ".", ",")).when(style == 5, F.lit("")).otherwise(F.lit("NA")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", text.alias("txt"))


@query("B3", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 7 IN (5, 6) THEN NULL ELSE l_extendedprice END AS number
FROM lineitem""")
def parse_number(t):
    return _number_texts(t).select("l_orderkey", "l_linenumber", parse.parse_number("txt").alias("number"))


@query("B4", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber % 7 IN (5, 6) THEN NULL ELSE round(l_extendedprice * 100) END::DOUBLE AS number,
  CASE WHEN l_linenumber % 7 IN (5, 6) OR l_extendedprice <> floor(l_extendedprice) THEN NULL
       ELSE l_extendedprice END AS strict_number FROM lineitem""")
def parse_int(t):
    return _number_texts(t).select(
        "l_orderkey", "l_linenumber", parse.parse_int("txt").cast("double").alias("number"),
        parse.parse_int("txt", strict=True).cast("double").alias("strict_number"))


@query("B5", f"SELECT {SPEC_COLUMNS} FROM lineitem")
def convert_types(t):
    texts = t.lineitem.select(*[F.col(f.name).cast("string").alias(f.name) for f in SPEC])
    return parse.convert_types(texts, SPEC, sort=True)


@query("B6", """
SELECT o_orderkey, strftime(TIMESTAMP '1899-12-30' + to_seconds(43200 + 86400 * (35000 + o_orderkey % 10000)),
  '%Y-%m-%d %H:%M:%S') AS ts FROM orders""")
def serial_to_ts(t):
    serial = 35000 + F.col("o_orderkey") % 10000 + F.lit(0.5)
    return t.orders.select("o_orderkey", F.date_format(parse.serial_to_ts(serial), "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query("B7", f"""
SELECT event_id, {sr("date_diff('day', DATE '1899-12-30', ts::DATE) + (epoch(ts) - epoch(date_trunc('day', ts))) / 86400.0")}
  AS serial FROM events""")
def ts_to_serial(t):
    return t.events.select("event_id", r(parse.ts_to_serial("ts")).alias("serial"))


@query("B8", """
SELECT o_orderkey, 3::BIGINT AS n, 1::BIGINT AS n_null, o_totalprice + o_orderkey AS total FROM orders""")
def parse_series(t):
    text = F.concat_ws(";", F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit(""), F.col("o_orderkey"))
    values = parse.parse_series(text)
    return t.orders.select(
        "o_orderkey", F.size(values).cast("bigint").alias("n"),
        F.size(F.filter(values, lambda v: v.isNull())).cast("bigint").alias("n_null"),
        F.aggregate(values, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0))).alias("total"))


@query("B9", """
SELECT o_orderkey, 1.0::DOUBLE AS ds, (o_orderkey % 100)::DOUBLE AS y FROM orders
UNION ALL SELECT o_orderkey, 2.0, NULL FROM orders""")
def parse_pairs(t):
    text = F.concat(F.lit("1:"), F.col("o_orderkey") % 100, F.lit(";2:"))
    return parse.parse_pairs(t.orders.select("o_orderkey", text.alias("pairs")), "pairs")


@query("B10", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 1 THEN printf('%.5f', l_tax) END AS txt FROM lineitem")
def format_result(t):
    tax = F.when(F.col("l_linenumber") > 1, F.col("l_tax"))
    return t.lineitem.select("l_orderkey", "l_linenumber", parse.format_result(tax).alias("txt"))


@query("B11", """
SELECT l_orderkey, l_linenumber, 'No: ' || printf('%.3f', 1 - l_discount) || ', Yes: ' || printf('%.3f', l_discount) AS proba
FROM lineitem""")
def format_proba(t):
    p = F.array(1 - F.col("l_discount"), F.col("l_discount"))
    text = parse.format_proba(F.array(F.lit("No"), F.lit("Yes")), p)
    return t.lineitem.select("l_orderkey", "l_linenumber", text.alias("proba"))


@query("B12", """
SELECT l_orderkey, l_linenumber, CASE round_even(l_quantity / 10, 0)::INT WHEN 0 THEN 'low' WHEN 1 THEN 'mid' WHEN 2 THEN 'mid'
  WHEN 3 THEN 'high' ELSE (round_even(l_quantity / 10, 0)::INT)::VARCHAR END AS label FROM lineitem""")
def decode_labels(t):
    label = parse.decode_labels(F.col("l_quantity") / 10, {0: "low", 1: "mid", 2: "mid", 3: "high"})
    return t.lineitem.select("l_orderkey", "l_linenumber", label.alias("label"))


@query("B13", "SELECT p_partkey, replace(replace(lower(p_name || '''s Day'), ' ', '_'), '''', '') AS name FROM part")
def normalize_name(t):
    return t.part.select("p_partkey", parse.normalize_name(F.concat("p_name", F.lit("'s Day"))).alias("name"))


@query("B14", f"""
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN {sr('ln(c_acctbal)')} END AS logged,
  CASE WHEN c_acctbal > 0 THEN {sr('c_acctbal', 2)} END AS back FROM customer""")
def log_transform(t):
    logged = parse.log_transform("c_acctbal")
    return t.customer.select("c_custkey", r(logged).alias("logged"), r(parse.exp_inverse(logged), 2).alias("back"))


def _places(t):
    """A point per customer: coordinates derived from the key and the balance."""
    lat = F.col("c_custkey") % 90 - 45 + F.lit(0.25)
    long = F.col("c_custkey") % 360 - 180 + F.lit(0.5)
    return t.customer.select("c_custkey", lat.alias("lat"), long.alias("long"))


SQL_PLACES = "places AS (SELECT c_custkey, c_custkey % 90 - 45 + 0.25::DOUBLE AS lat, c_custkey % 360 - 180 + 0.5::DOUBLE AS long FROM customer)"


@query("B15", f"WITH {SQL_PLACES} SELECT c_custkey, {sr('radians(lat)')} AS lat, {sr('radians(long)')} AS long FROM places")
def to_radians(t):
    lat, long = distance.to_radians("lat", "long")
    return _places(t).select("c_custkey", r(lat).alias("lat"), r(long).alias("long"))


@query("B16", "SELECT o_orderkey AS key, o_orderstatus AS label FROM orders")
def rename_columns(t):
    return parse.rename(t.orders, {"o_orderkey": "key", "o_orderstatus": "label"})


@query("B", """
SELECT o_orderkey, date_diff('day', DATE '1899-12-30', o_orderdate::DATE)::BIGINT AS serial, (o_orderkey * 10)::BIGINT AS number,
  printf('%.5f', o_orderkey::DOUBLE) AS txt, 5.0::DOUBLE AS dist, o_totalprice AS price,
  strftime(DATE '1899-12-30' + (40000 + o_orderkey % 1000)::INT, '%Y-%m-%d') AS day FROM orders""")
def sql_functions(t):
    parse.register_sql_functions(t.spark)
    return t.orders.selectExpr(
        "o_orderkey", "CAST(serial_day(CAST(o_orderdate AS DATE)) AS BIGINT) AS serial",
        "parse_int_text(concat(o_orderkey, '.0')) AS number", "format_result(CAST(o_orderkey AS DOUBLE)) AS txt",
        "euclidean_distance(array(0D, 3D), array(CAST(o_orderkey AS DOUBLE) - o_orderkey + 4D, 0D)) AS dist",
        "parse_number_text(translate(format_number(o_totalprice, 2), ',.', '.,')) AS price",
        "date_format(serial_timestamp(40000 + o_orderkey % 1000), 'yyyy-MM-dd') AS day")


# ---- null handling -------------------------------------------------------------------------


def _gappy(t):
    """Line items in which every seventh quantity and every line of flag R has no value."""
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 7 != 0, F.col("l_quantity")).alias("qty"),
        F.when(F.col("l_returnflag") != "R", F.col("l_discount")).alias("disc"))


SQL_GAPPY = """gappy AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN (l_orderkey + l_linenumber) % 7 <> 0 THEN l_quantity END AS qty,
  CASE WHEN l_returnflag <> 'R' THEN l_discount END AS disc FROM lineitem)"""


def _filled_sql(fill_qty: str, fill_disc: str) -> str:
    return f"""WITH {SQL_GAPPY} SELECT l_orderkey, l_linenumber, {sr(f'coalesce(qty, {fill_qty})')} AS qty,
      {sr(f'coalesce(disc, {fill_disc})')} AS disc FROM gappy"""


def _filled(t, method):
    gappy = _gappy(t)
    values = nulls.missing_values(gappy, ["qty", "disc"], method)
    return nulls.fill_missing(gappy, values).select("l_orderkey", "l_linenumber", r("qty").alias("qty"), r("disc").alias("disc"))


@query("C1", """
SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS key, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * 2 END AS twice
FROM orders""")
def split_null_keys(t):
    keyed = t.orders.select(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("key"), "o_totalprice")
    return nulls.split_null_keys(keyed, "key", lambda d: d.select("key", (F.col("o_totalprice") * 2).alias("twice")))


@query("C2", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def filter_roles(t):
    return nulls.filter_roles(t.lineitem, SPEC, ["identifier", "feature"])


@query("C3", f"WITH {SQL_GAPPY} SELECT * FROM gappy WHERE qty IS NOT NULL AND disc IS NOT NULL")
def drop_incomplete(t):
    return nulls.drop_incomplete(_gappy(t))


@query("C4", _filled_sql("0", "0"))
def fill_zeros(t):
    return _filled(t, "zeros")


@query("C5", _filled_sql("(SELECT avg(qty) FROM gappy)", "(SELECT avg(disc) FROM gappy)"))
def fill_mean(t):
    return _filled(t, "mean")


@query("C6", _filled_sql("(SELECT median(qty) FROM gappy)", "(SELECT median(disc) FROM gappy)"))
def fill_median(t):
    return _filled(t, "median")


def _sql_mode(c):
    return f"(SELECT {c} FROM gappy WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("C7", _filled_sql(_sql_mode("qty"), _sql_mode("disc")))
def fill_mode(t):
    return _filled(t, "mode")


@query("C8", f"WITH {SQL_GAPPY} SELECT l_orderkey, l_linenumber, {sr('qty')} AS qty, {sr('disc')} AS disc FROM gappy")
def fill_none(t):
    return _filled(t, "none")


@query("C9", f"""WITH {SQL_GAPPY}
SELECT l_orderkey, count(disc)::BIGINT AS n_known, (count(disc) >= 3)::INT AS enough FROM gappy GROUP BY 1""")
def is_min_history(t):
    return nulls.is_min_history(_gappy(t), ["l_orderkey"], "disc").withColumn("enough", F.col("enough").cast("int"))


@query("C10", """
SELECT p_partkey, (p_name LIKE '%ring' AND length(p_name) > 4)::INT AS globbed,
  regexp_matches(p_name, '\\bbolt\\b')::INT AS worded FROM part""")
def match_patterns(t):
    return t.part.select("p_partkey", nulls.glob_match("p_name", "?*ring").cast("int").alias("globbed"),
                         nulls.word_match("p_name", "bolt").cast("int").alias("worded"))


# ---- scalers -------------------------------------------------------------------------------

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


def _scaled(t, scaler, **options):
    fitted = scale.fit_scaler(t.lineitem, NUMBERS, scaler, **options)
    done = scale.scale(t.lineitem.select("l_orderkey", "l_linenumber", *NUMBERS), NUMBERS, fitted)
    return done.select("l_orderkey", "l_linenumber", *[r(c).alias(c) for c in NUMBERS])


def _scaled_sql(center: str, spread: str) -> str:
    parts = ", ".join(
        sr(f"({c} - {center.format(c=c)}) / {spread.format(c=c)}") + f" AS {c}" for c in NUMBERS)
    stats = ", ".join(
        f"avg({c}) AS {c}_avg, stddev_pop({c}) AS {c}_std, min({c}) AS {c}_min, max({c}) AS {c}_max, "
        f"max(abs({c})) AS {c}_abs, quantile_cont({c}, 0.25) AS {c}_q1, median({c}) AS {c}_q2, quantile_cont({c}, 0.75) AS {c}_q3"
        for c in NUMBERS)
    return f"SELECT l_orderkey, l_linenumber, {parts} FROM lineitem, (SELECT {stats} FROM lineitem)"


@query("D1", _scaled_sql("{c}_avg", "{c}_std"))
def scale_standard(t):
    return _scaled(t, "standard")


@query("D2", _scaled_sql("{c}_min", "({c}_max - {c}_min)"))
def scale_minmax(t):
    return _scaled(t, "minmax")


@query("D3", _scaled_sql("0", "{c}_abs"))
def scale_maxabs(t):
    return _scaled(t, "maxabs")


@query("D4", _scaled_sql("{c}_q2", "({c}_q3 - {c}_q1)"))
def scale_robust(t):
    return _scaled(t, "robust")


@query("D5", f"""
WITH q AS (SELECT quantile_cont(l_extendedprice, [0, 0.25, 0.5, 0.75, 1]) AS g FROM lineitem),
p AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS x, g,
  CASE WHEN l_extendedprice < g[2] THEN 1 WHEN l_extendedprice < g[3] THEN 2 WHEN l_extendedprice < g[4] THEN 3 ELSE 4 END AS i
  FROM lineitem, q)
SELECT l_orderkey, l_linenumber, {sr('(i - 1 + (x - g[i]) / (g[i + 1] - g[i])) / 4')} AS l_extendedprice FROM p""")
def scale_quantile(t):
    fitted = scale.fit_scaler(t.lineitem, ["l_extendedprice"], "quantile", n_quantiles=5)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return scale.scale(rows, ["l_extendedprice"], fitted).withColumn("l_extendedprice", r("l_extendedprice"))


@query("D5")
def scale_quantile_normal(t):
    return _scaled(t, "quantile", n_quantiles=100, output_distribution="normal")


@query("D6", _scaled_sql("0", "1"))
def scale_none(t):
    return _scaled(t, "none")


@query("D7", f"SELECT o_orderkey, {sr('o_totalprice', 2)} AS restored FROM orders")
def inverse_scale(t):
    fitted = scale.fit_scaler(t.orders, ["o_totalprice"], "standard")
    scaled = scale.scale(t.orders, ["o_totalprice"], fitted)
    return scaled.select("o_orderkey", r(fitted.invert("o_totalprice"), 2).alias("restored"))


@query("D8", f"""
WITH s AS (SELECT c_nationkey, avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS d FROM customer GROUP BY 1)
SELECT c_custkey, c_nationkey, {sr('(c_acctbal - m) / d')} AS c_acctbal FROM customer JOIN s USING (c_nationkey)""")
def scale_per_group(t):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return scale.scale_by_group(rows, ["c_nationkey"], ["c_acctbal"]).withColumn("c_acctbal", r("c_acctbal"))


@query("D8", f"""
WITH s AS (SELECT c_nationkey, quantile_cont(c_acctbal, 0.25) AS a, quantile_cont(c_acctbal, 0.5) AS m, quantile_cont(c_acctbal, 0.75) AS b FROM customer GROUP BY 1),
p AS (SELECT c_custkey, c_nationkey, rank() OVER w AS first, count(*) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) AS last, count(*) OVER (PARTITION BY c_nationkey) AS n,
  min(c_acctbal) OVER (PARTITION BY c_nationkey) = c_acctbal AS low, max(c_acctbal) OVER (PARTITION BY c_nationkey) = c_acctbal AS high FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal))
SELECT c_custkey, {sr('(c_acctbal - m) / (CASE WHEN b = a THEN 1 ELSE b - a END)')} AS robust,
  {sr('CASE WHEN low THEN 0.0 WHEN high THEN 1.0 ELSE (first + last - 2) / 2.0 / greatest(n - 1, 1) END', 6)} AS quantile
FROM customer JOIN s USING (c_nationkey) JOIN p USING (c_custkey)""")
def scale_per_group_by_rank(t):
    rows = t.customer.select("c_custkey", "c_nationkey", F.col("c_acctbal").alias("robust"), F.col("c_acctbal").alias("quantile"))
    done = scale.scale_by_group(scale.scale_by_group(rows, ["c_nationkey"], ["robust"], "robust"), ["c_nationkey"], ["quantile"], "quantile")
    return done.select("c_custkey", r("robust").alias("robust"), r("quantile", 6).alias("quantile"))


# ---- distances -----------------------------------------------------------------------------


@query("L13", f"""
WITH v AS (SELECT l_orderkey, l_linenumber, l_quantity AS a1, l_discount * 100 AS a2, l_tax * 100 AS b1, l_linenumber::DOUBLE AS b2
  FROM lineitem)
SELECT l_orderkey, l_linenumber, {sr('sqrt((a1-b1)*(a1-b1)+(a2-b2)*(a2-b2))')} AS euclidean,
  {sr('abs(a1-b1)+abs(a2-b2)')} AS manhattan, {sr('pow(pow(abs(a1-b1),3)+pow(abs(a2-b2),3),1.0/3)')} AS minkowski,
  {sr('coalesce(abs(a1-b1)/nullif(abs(a1)+abs(b1),0),0)+coalesce(abs(a2-b2)/nullif(abs(a2)+abs(b2),0),0)')} AS canberra,
  {sr('1-(a1*b1+a2*b2)/(sqrt(a1*a1+a2*a2)*sqrt(b1*b1+b2*b2))')} AS cosine FROM v""")
def distances(t):
    a = F.array(F.col("l_quantity"), F.col("l_discount") * 100)
    b = F.array(F.col("l_tax") * 100, F.col("l_linenumber").cast("double"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", r(distance.euclidean(a, b)).alias("euclidean"), r(distance.manhattan(a, b)).alias("manhattan"),
        r(distance.minkowski(a, b, 3.0)).alias("minkowski"), r(distance.canberra(a, b)).alias("canberra"),
        r(distance.cosine(a, b)).alias("cosine"))


@query("L13", f"""WITH {SQL_PLACES}
SELECT c_custkey, {sr('6371.0088 * 2 * asin(least(sqrt(pow(sin((radians(10.0) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(10.0)) * pow(sin((radians(20.0) - radians(long)) / 2), 2)), 1.0))', 2)} AS km
FROM places""")
def haversine_distance(t):
    lat, long = distance.to_radians("lat", "long")
    angle = distance.haversine(lat, long, F.radians(F.lit(10.0)), F.radians(F.lit(20.0)))
    return _places(t).select("c_custkey", r(angle * distance.EARTH_KM, 2).alias("km"))
