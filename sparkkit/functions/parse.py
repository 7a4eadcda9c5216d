"""Column expressions that parse and format values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spec import SQL_TYPES, Feature, check_spec

# fixed value: day zero of serial day numbers
SERIAL_EPOCH = "1899-12-30"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pack_features(cols: Sequence[str | Column], sep: str = "|") -> Column:
    """One delimited string per row; nulls become empty fields."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def features_expression(spec: Sequence[Feature], lags: bool = False, lag_target: bool = False) -> list[str]:
    """Names of the columns a caller has to pack for a model, in definition order."""
    check_spec(spec)
    wanted = {"feature"} | ({"identifier"} if lags else set()) | ({"target"} if lag_target else set())
    return [f.name for f in spec if f.role in wanted]


def unpack_features(col: str | Column, names: Sequence[str], sep: str = "|") -> list[Column]:
    """Split a packed string into named string columns; a wrong field count is an error."""
    parts = F.split(_col(col), re.escape(sep), -1)
    problem = F.raise_error(F.concat(F.lit(f"expected {len(names)} fields, got "), F.size(parts)))
    checked = F.when(F.size(parts) == len(names), parts).otherwise(problem.cast("array<string>"))
    return [F.nullif(checked.getItem(i), F.lit("")).alias(n) for i, n in enumerate(names)]


def parse_number(col: str | Column) -> Column:
    """Number in any regional notation; empty or unparseable text becomes null.

    The separator that occurs last and only once is the decimal separator.
    """
    s = F.translate(_col(col), " ", "")
    commas = F.length(s) - F.length(F.translate(s, ",", ""))
    dots = F.length(s) - F.length(F.translate(s, ".", ""))
    last_comma = F.when(commas > 0, F.length(s) - F.instr(F.reverse(s), ",") + 1).otherwise(0)
    last_dot = F.when(dots > 0, F.length(s) - F.instr(F.reverse(s), ".") + 1).otherwise(0)
    no_commas = F.when((commas > 1) | (last_comma < last_dot), F.translate(s, ",", "")).otherwise(s)
    cleaned = F.when((dots > 1) | (last_comma > last_dot), F.translate(no_commas, ".", "")).otherwise(no_commas)
    return F.translate(cleaned, ",", ".").try_cast("double")


def parse_int(col: str | Column, strict: bool = False) -> Column:
    """Whole number without its grouping marks; `strict` refuses text that has a fraction."""
    if not strict:
        return F.translate(_col(col), ",. ", "").try_cast("bigint")
    value = parse_number(col)
    return F.when(value == F.rint(value), value.try_cast("bigint"))


def convert_types(df: DataFrame, spec: Sequence[Feature], sort: bool = False) -> DataFrame:
    """Cast string columns to their declared types, optionally ordered by the identifier."""
    check_spec(spec)
    readers = {
        "bool": lambda c: F.lower(F.trim(F.col(c))).try_cast("boolean"),
        "int": parse_int,
        "float": parse_number,
        "str": lambda c: F.col(c).cast("string"),
    }
    out = df.select(*[
        (readers[f.dtype](f.name) if dict(df.dtypes)[f.name] == "string" else F.col(f.name).cast(SQL_TYPES[f.dtype]))
        .alias(f.name)
        for f in spec
    ])
    keys = [f.name for f in spec if f.role == "identifier"]
    return out.orderBy(*keys) if sort and keys else out


def serial_to_ts(col: str | Column) -> Column:
    """Serial day number -> timestamp without time zone, to the microsecond."""
    micros = F.round(_col(col).cast("double") * 86400000000.0).cast("bigint")
    epoch = F.lit(SERIAL_EPOCH).cast("timestamp_ntz")
    whole = F.floor(micros / F.lit(86400000000)).cast("int")
    rest = (micros - whole.cast("bigint") * 86400000000) / F.lit(1000000.0)
    return epoch + F.make_dt_interval(days=whole, secs=rest.cast("decimal(18,6)"))


def ts_to_serial(col: str | Column) -> Column:
    """Timestamp (or date) -> serial day number with its fraction of a day."""
    ts = _col(col).cast("timestamp_ntz")
    days = F.datediff(ts.cast("date"), F.lit(SERIAL_EPOCH).cast("date"))
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
    return days + seconds / 86400.0


def parse_series(col: str | Column, sep: str = ";") -> Column:
    """'1;;3' -> array of numbers in which empty fields are null."""
    return F.transform(F.split(_col(col), re.escape(sep), -1), parse_number)


def parse_pairs(df: DataFrame, col: str, key: str = "ds", value: str = "y") -> DataFrame:
    """'ds:y;ds:y' -> one row per pair."""
    pair = F.split(F.col("__pair"), ":", 2)
    return (
        df.withColumn("__pair", F.explode(F.split(F.col(col), ";")))
        .filter(F.length("__pair") > 0)
        .withColumn(key, parse_number(pair.getItem(0)))
        .withColumn(value, parse_number(F.get(pair, F.lit(1))))
        .drop("__pair", col)
    )


def format_result(col: str | Column) -> Column:
    """Number as text with five decimals; null stays null."""
    c = _col(col)
    return F.when(c.isNotNull(), F.format_string("%.5f", c.cast("double")))


def format_proba(classes: Column, probabilities: Column) -> Column:
    """'No: 0.912, Yes: 0.088' from an array of class names and an array of probabilities."""
    return F.concat_ws(", ", F.zip_with(classes, probabilities, lambda k, p: F.format_string("%s: %.3f", k, p)))


def decode_labels(col: str | Column, labels: dict[int, str]) -> Column:
    """Rounded prediction -> label; a number without a label stays a number."""
    whole = F.rint(_col(col).cast("double")).cast("bigint")
    if not labels:
        return whole.cast("string")
    table = F.create_map(*[x for k, v in sorted(labels.items()) for x in (F.lit(int(k)).cast("bigint"), F.lit(v))])
    return F.coalesce(F.try_element_at(table, whole), whole.cast("string"))


def normalize_name(col: str | Column) -> Column:
    return F.translate(F.lower(_col(col)), " '", "_")


def log_transform(col: str | Column) -> Column:
    c = _col(col).cast("double")
    return F.when(c > 0, F.log(c))


def exp_inverse(col: str | Column) -> Column:
    return F.exp(_col(col))


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select and rename in one step; the mapping gives the output order."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def register_sql_functions(spark) -> None:
    """Make the parsers callable from SQL as temporary functions (no Python per row)."""
    spark.sql(r"""
        CREATE OR REPLACE TEMPORARY FUNCTION parse_int_text(s STRING) RETURNS BIGINT
        RETURN try_cast(translate(s, ',. ', '') AS BIGINT)""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION serial_day(d DATE) RETURNS INT
        RETURN datediff(d, DATE'1899-12-30')""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION format_result(x DOUBLE) RETURNS STRING
        RETURN CASE WHEN x IS NOT NULL THEN format_string('%.5f', x) END""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION euclidean_distance(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE
        RETURN sqrt(aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), CAST(0 AS DOUBLE), (s, v) -> s + v))""")
    # a mark is dropped when it occurs twice or stands before the last mark of the other kind
    last = "(CASE WHEN instr(t, '{m}') > 0 THEN length(t) - instr(reverse(t), '{m}') + 1 ELSE 0 END)"
    many = "length(t) - length(translate(t, '{m}', '')) > 1"
    comma, dot = last.format(m=","), last.format(m=".")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION parse_number_text(s STRING) RETURNS DOUBLE
        RETURN try_cast(translate(element_at(transform(array(translate(s, ' ', '')), t -> translate(translate(t,
          CASE WHEN {many.format(m=",")} OR {comma} < {dot} THEN ',' ELSE '' END, ''),
          CASE WHEN {many.format(m=".")} OR {comma} > {dot} THEN '.' ELSE '' END, '')), 1), ',', '.') AS DOUBLE)""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION serial_timestamp(x DOUBLE) RETURNS TIMESTAMP_NTZ
        RETURN timestamp_ntz'1899-12-30' + make_dt_interval(0, 0, 0, CAST(x * 86400 AS DECIMAL(18, 6)))""")
