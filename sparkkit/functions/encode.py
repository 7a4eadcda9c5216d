"""Feature encoders.  Vocabularies and category lists are learned once, on the training rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.durable import stored
from ..plans.ordered import match

MAX_COLUMNS = 10_000
SENT_TERMS = 500_000  # terms of a vocabulary that tasks hold as a whole
TASK_CHARS = 8_000_000  # characters of the texts that a task takes apart


def _bounded(rows: list, what: str) -> list:
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"{what} would make more than {MAX_COLUMNS} columns; hash it instead")
    return rows


def fit_categories(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Distinct training values per column, sorted (one output column each)."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]
    found = df.select(F.inline(F.array(*pairs))).filter("value is not null").distinct()
    rows = _bounded(found.limit(MAX_COLUMNS + 1).collect(), "one-hot encoding")
    return {c: sorted(r["value"] for r in rows if r["feature"] == c) for c in cols}


def one_hot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """0/1 column `col_value` per training value; unseen values and nulls give zeros only."""
    flags = [
        F.when(F.col(c).cast("string") == v, 1).otherwise(0).alias(f"{c}_{v}")
        for c, values in categories.items() for v in values
    ]
    return df.select(*[c for c in df.columns if c not in categories], *flags)


def _hash_part(text: Column, start: int) -> Column:
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("bigint")


def hash_columns(col: str, n: int) -> list[Column]:
    """`n` signed counts of the characters of a value: one md5 chooses both bucket and sign."""
    chars = F.split(F.coalesce(F.col(col).cast("string"), F.lit("")), "")
    signed = F.transform(
        F.filter(chars, lambda ch: ch != ""),
        lambda ch: F.struct(
            (_hash_part(ch, 1) % n).alias("bucket"),
            F.when(_hash_part(ch, 9) % 2 == 0, 1).otherwise(-1).alias("sign"),
        ),
    )

    def count_of(j):
        return F.aggregate(signed, F.lit(0), lambda s, x: s + F.when(x["bucket"] == j, x["sign"]).otherwise(0))

    return [count_of(j).cast("double").alias(f"{col}_{j}") for j in range(n)]


def encode_distinct(df: DataFrame, col: str, encode: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Encode each distinct value once and join the result back to the rows.

    No broadcast hint: the number of distinct values is unknown, adaptive execution decides.
    """
    return match(df, encode(df.select(col).distinct()), [col], "left")


def hash_encode(df: DataFrame, col: str, n: int) -> DataFrame:
    return encode_distinct(df, col, lambda d: d.select(col, *hash_columns(col, n)))


# fixed value: a word is a run of two or more word characters
WORD = r"[\p{L}\p{N}_]{2,}"


def tokens(col: str | Column, analyzer: str = "word", ngram_range: tuple[int, int] = (1, 1),
           stop_words: Sequence[str] | None = None) -> Column:
    """Array of terms: word n-grams, or character n-grams (`char`)."""
    text = F.lower(F.col(col) if isinstance(col, str) else col)
    if analyzer == "word":
        parts, glue = F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), " "
        if stop_words:
            parts = F.filter(parts, lambda w: ~w.isin(*stop_words))
    elif analyzer == "char":
        parts, glue = F.filter(F.split(text, ""), lambda ch: ch != ""), ""
    else:
        raise ValueError("analyzer must be 'word' or 'char'")
    low, high = ngram_range
    if (low, high) == (1, 1):
        return parts

    def runs(words, n):
        places = F.sequence(F.lit(1), F.size(words) - n + 1)
        joined = F.transform(places, lambda i: F.array_join(F.slice(words, i, n), glue))
        return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))

    # bound to a variable, the words are cut out once a text
    return F.flatten(F.transform(F.array(parts), lambda words: F.concat(*[runs(words, n) for n in range(low, high + 1)])))


def term_counts(df: DataFrame, key: str, col: str, **options) -> DataFrame:
    """(key, term, n): one row per text and term; adds up on the map side."""
    exploded = df.select(key, F.explode(tokens(col, **options)).alias("term"))
    return exploded.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def fit_vocabulary(counts: DataFrame, min_df: int = 1, max_features: int | None = None) -> DataFrame:
    """(term, df, total) of the kept terms; the most frequent ones when `max_features` is given."""
    terms = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("total"))
    terms = terms.filter(F.col("df") >= min_df)
    return terms.orderBy(F.desc("total"), "term").limit(max_features) if max_features else terms


def count_vectorize(df: DataFrame, key: str, col: str, min_df: int = 1, max_features: int | None = None,
                    **options) -> DataFrame:
    """Counts of the vocabulary terms in long form."""
    counts = term_counts(df, key, col, **options)
    if min_df <= 1 and max_features is None:
        return counts
    return counts.join(fit_vocabulary(counts, min_df, max_features).select("term"), "term", "left_semi")


def dealt_texts(df: DataFrame, key: str, col: str) -> tuple[DataFrame, int]:
    """((key, col) dealt out by key, rows): parts of about `TASK_CHARS`, so what a task counts does not grow with the table."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(col)).alias("chars")).first()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(size["chars"] or 0) // TASK_CHARS))
    return df.select(key, col).repartition(parts, key), size["n"]


def tf_idf(df: DataFrame, key: str, col: str, min_df: int = 1, max_features: int | None = None, **options) -> DataFrame:
    """(key, term, weight): n * (ln((1+N)/(1+df)) + 1), each text scaled to length one.

    The texts are dealt out by key, as they are shorter than their terms; counts and norms then need no exchange.  A
    vocabulary of at most `SENT_TERMS` is sent to the tasks, a larger one is joined.
    """
    texts, n_texts = dealt_texts(df, key, col)
    counts = term_counts(texts, key, col, **options)
    vocabulary = stored(fit_vocabulary(counts, min_df, max_features).select("term", "df"))
    idf = vocabulary.select("term", (F.log((1.0 + n_texts) / (1 + F.col("df"))) + 1).alias("idf"))
    if vocabulary.count() <= SENT_TERMS:
        idf = F.broadcast(idf)
    weighted = counts.join(idf, "term").withColumn("w", F.col("n") * F.col("idf"))
    # a window partition is the different terms of one text
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return weighted.withColumn("norm", norm).select(key, "term", (F.col("w") / F.col("norm")).alias("weight"))


def fit_characters(df: DataFrame, col: str) -> list[str]:
    chars = df.select(F.explode(F.array_distinct(F.split(F.col(col).cast("string"), ""))).alias("ch")).distinct()
    rows = _bounded(chars.filter("ch <> ''").limit(MAX_COLUMNS + 1).collect(), "character encoding")
    return sorted(r["ch"] for r in rows)


def char_columns(col: str, characters: Sequence[str]) -> list[Column]:
    """0/1 per known character, named by its code point."""
    text = F.coalesce(F.col(col).cast("string"), F.lit(""))
    return [F.contains(text, F.lit(ch)).cast("int").alias(f"{col}_{ord(ch)}") for ch in characters]


def char_one_hot(df: DataFrame, col: str, characters: Sequence[str]) -> DataFrame:
    return encode_distinct(df, col, lambda d: d.select(col, *char_columns(col, characters)))


def align_columns(df: DataFrame, fitted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Fitted columns in fitted order: missing ones are added as 0, others are dropped."""
    have = set(df.columns)
    return df.select(*keep, *[
        (F.coalesce(F.col(f"`{c}`"), F.lit(0)) if c in have else F.lit(0)).alias(c) for c in fitted
    ])


def safe_name(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", name)
