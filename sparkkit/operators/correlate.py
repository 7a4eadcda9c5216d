"""Correlation of series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import HOT_GROUP_ROWS, average_rank, match, with_position

METHODS = ("pearson", "spearman", "kendall")


def _complete(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    pairs = df.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return pairs.dropna("any", subset=["x", "y"])


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, correlation); null for fewer than two pairs or a constant series."""
    stats = _complete(df, by, x, y).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop("x", "y").alias("c"),
        F.stddev_pop("x").alias("sx"), F.stddev_pop("y").alias("sy"))
    return stats.select(*by, "n", F.try_divide(F.col("c"), F.col("sx") * F.col("sy")).alias("correlation"))


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = (), hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """Pearson of average ranks, ranked after incomplete pairs are dropped."""
    pairs = _complete(df, by, x, y)
    ranked = average_rank(average_rank(pairs, by, "x", "rx", hot), by, "y", "ry", hot)
    return pearson(ranked, "rx", "ry", by)


def _inversions(unit: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Per unit (0..k-1, rows sorted by unit): pairs out of order in `place`, by splitting on bits."""
    n = len(unit)
    rank = np.empty(n, dtype=np.int64)
    rank[np.lexsort((place, unit))] = np.arange(n)
    counts = np.zeros(int(unit[-1]) + 1)
    for bit in reversed(range(max(n - 1, 1).bit_length())):
        # rows are grouped by the higher bits and keep their sequence inside a group
        high = rank >> (bit + 1)
        one = (rank >> bit) & 1
        ones = np.cumsum(one)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1])
        base = np.repeat(ones[starts] - one[starts], np.diff(np.concatenate([starts, [n]])))
        counts += np.bincount(unit, weights=(ones - base) * (1 - one), minlength=len(counts))
        step = np.argsort(rank >> bit, kind="stable")
        rank, unit = rank[step], unit[step]
    return counts


def _count_inversions(rows: DataFrame, group: Sequence[str], block: str, cell: str | None, packs: int, schema: str) -> DataFrame:
    """(group..., inv): inversions inside each block, less those inside each cell of the block.

    Small units share a task: they are packed by a hash of their key, a large one is one block long.
    """
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns="__pack").sort_values("p")
        units = pdf.groupby([*group, block], dropna=False, sort=False).ngroup().to_numpy()
        order = np.argsort(units, kind="stable")
        pdf, units = pdf.iloc[order], units[order]
        inv = _inversions(units, pdf["q"].to_numpy())
        if cell:
            parts = pdf.groupby([*group, block, cell], dropna=False, sort=False).ngroup().to_numpy()
            inside = np.argsort(parts, kind="stable")
            lost = _inversions(parts[inside], pdf["q"].to_numpy()[inside])
            owner = units[inside][np.flatnonzero(np.diff(parts[inside], prepend=-1))]
            inv = inv - np.bincount(owner, weights=lost, minlength=len(inv))
        heads = pdf.iloc[np.flatnonzero(np.diff(units, prepend=-1))]
        return heads[list(group)].assign(inv=inv)

    pack = F.pmod(F.xxhash64(*group, block), F.lit(packs))
    return rows.withColumn("__pack", pack).groupBy("__pack").applyInPandas(count, schema)


def _crossings(grid: np.ndarray) -> float:
    """Pairs of points in cells (r, c), (r', c') with r < r' and c > c', from the cell counts."""
    after = np.cumsum(grid[::-1], axis=0)[::-1]
    below = np.vstack([after[1:], np.zeros((1, grid.shape[1]))])
    left = np.cumsum(below, axis=1) - below
    return float(np.sum(grid * left))


def kendall(df: DataFrame, x: str, y: str, by: Sequence[str] = (), block_rows: int = 65_536, max_blocks: int = 1_000,
            hot: int = HOT_GROUP_ROWS) -> DataFrame:
    """(by..., n, correlation): tau-b.

    Discordant pairs are the inversions between two sort orders.  Positions in both orders cut a
    series into equal blocks whatever its values: pairs inside a block of either order are counted
    by one task per block, pairs that differ in both from a small grid of counts.
    """
    by = list(by)
    pairs = _complete(df, by, x, y)
    # a repeated (x, y) is told apart by a number inside its own tie
    tied = pairs.groupBy(*by, "x", "y").agg(F.count(F.lit(1)).alias("m"))

    def tie_pairs(freq: DataFrame, count: str, name: str) -> DataFrame:
        m = F.col(count).cast("double")
        return freq.groupBy(*by).agg(F.sum(m * (m - 1) / 2).alias(name))

    numbered = tied.select(*by, "x", "y", F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("copy"))
    first = with_position(numbered, by, ["x", "y", "copy"], "p", hot)
    both = with_position(first.withColumn("q_tie", F.col("p")), by, ["y", "q_tie"], "q", hot)
    group = by or ["__all"]
    rows = both if by else both.withColumn("__all", F.lit(0))
    totals = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    packs = max(pairs.count() // block_rows, 1) * 8
    size = F.greatest(F.lit(block_rows), F.ceil(F.col("n") / max_blocks))
    rows = match(rows, totals, group).withColumn("size", size).select(
        *group, "n", "size", "p", "q", F.floor(F.col("p") / F.col("size")).alias("bp"), F.floor(F.col("q") / F.col("size")).alias("bq"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*group).schema) + ", inv double"

    def cells(pdf: pd.DataFrame) -> pd.DataFrame:
        grid = np.zeros((int(pdf["bp"].max()) + 1, int(pdf["bq"].max()) + 1))
        grid[pdf["bp"].to_numpy(), pdf["bq"].to_numpy()] = pdf["c"]
        return pdf[group].iloc[:1].assign(inv=_crossings(grid))

    several = rows.filter(F.col("n") > F.col("size"))
    counted = several.groupBy(*group, "bp", "bq").agg(F.count(F.lit(1)).alias("c"))
    inversions = (
        _count_inversions(rows, group, "bp", None, packs, schema)
        # pairs that share both blocks were counted by the first order
        .unionByName(_count_inversions(several, group, "bq", "bp", packs, schema))
        .unionByName(counted.groupBy(*group).applyInPandas(cells, schema))
    ).groupBy(*group).agg(F.sum("inv").alias("discordant"))

    x_ties = tie_pairs(tied.groupBy(*by, "x").agg(F.sum("m").alias("t")), "t", "n1")
    y_ties = tie_pairs(tied.groupBy(*by, "y").agg(F.sum("m").alias("t")), "t", "n2")
    xy_ties = tie_pairs(tied, "m", "n3")
    out = match(totals, inversions, group)
    for part in (x_ties, y_ties, xy_ties):
        out = match(out, part if by else part.withColumn("__all", F.lit(0)), group)
    n0 = F.col("n") * (F.col("n").cast("double") - 1) / 2
    balance = n0 - F.col("n1") - F.col("n2") + F.col("n3") - 2 * F.col("discordant")
    tau = F.try_divide(balance, F.sqrt((n0 - F.col("n1")) * (n0 - F.col("n2"))))
    return out.select(*by, "n", tau.alias("correlation"))


def correlate(df: DataFrame, x: str, y: str, by: Sequence[str] = (), method: str = "pearson") -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    return {"pearson": pearson, "spearman": spearman, "kendall": kendall}[method](df, x, y, by)


def correlate_arrays(a: Column, b: Column) -> Column:
    """Pearson of two array columns of a row; pairs with a null are dropped, unequal lengths give null."""
    pairs = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["a"].isNotNull() & p["b"].isNotNull())
    total = lambda f: F.aggregate(pairs, F.lit(0.0), lambda s, p: s + f(p))
    n = F.size(pairs)
    ma, mb = F.try_divide(total(lambda p: p["a"]), n), F.try_divide(total(lambda p: p["b"]), n)
    sab = total(lambda p: (p["a"] - ma) * (p["b"] - mb))
    saa = total(lambda p: (p["a"] - ma) * (p["a"] - ma))
    sbb = total(lambda p: (p["b"] - mb) * (p["b"] - mb))
    return F.when(F.size(a) == F.size(b), F.try_divide(sab, F.sqrt(saa * sbb)))


def _ties(change: np.ndarray, unit: np.ndarray, units: int) -> np.ndarray:
    """Per unit: pairs inside the runs of sorted rows that begin where `change` is true."""
    starts = np.flatnonzero(change)
    m = np.diff(np.append(starts, len(unit))).astype(float)
    return np.bincount(unit[starts], weights=m * (m - 1) / 2, minlength=units)


def _taus(unit: np.ndarray, x: np.ndarray, y: np.ndarray, units: int) -> np.ndarray:
    """Tau-b of every unit (0..units-1), NaN for fewer than two pairs or a constant series."""
    order = np.lexsort((y, x, unit))
    unit, x, y = unit[order], x[order], y[order]
    if not len(unit):
        return np.full(units, np.nan)
    new = np.diff(unit, prepend=-1) != 0
    new_x = new | (np.diff(x, prepend=np.nan) != 0)
    n1, n3 = _ties(new_x, unit, units), _ties(new_x | (np.diff(y, prepend=np.nan) != 0), unit, units)
    by_y = np.lexsort((y, unit))
    n2 = _ties(new | (np.diff(y[by_y], prepend=np.nan) != 0), unit, units)
    place = np.empty(len(unit), dtype=np.int64)
    place[by_y] = np.arange(len(unit))
    discordant = np.zeros(units)
    found = _inversions(unit, place)
    discordant[: len(found)] = found
    n = np.bincount(unit, minlength=units).astype(float)
    n0 = n * (n - 1) / 2
    scale = np.sqrt((n0 - n1) * (n0 - n2))
    return np.where(scale > 0, (n0 - n1 - n2 + n3 - 2 * discordant) / np.where(scale > 0, scale, 1.0), np.nan)


ROW_PAIRS = 1_000  # pairs of a row up to which its tau is computed in place
_BATCH_PAIRS = 500_000


def _row_tau(a: pd.Series, b: pd.Series) -> pd.Series:
    """Tau of two array columns, row by row."""
    sizes = np.array([len(v) if v is not None and w is not None and len(v) == len(w) else 0 for v, w in zip(a, b)], dtype=np.int64)
    out = np.full(len(sizes), np.nan)
    ends = np.cumsum(sizes)
    s = 0
    while s < len(sizes):
        e = max(int(np.searchsorted(ends, ends[s] - sizes[s] + _BATCH_PAIRS, side="right")), s + 1)
        at = [i for i in range(s, e) if sizes[i]]
        if at:
            x, y = (np.concatenate([np.asarray(v.iloc[i], dtype=float) for i in at]) for v in (a, b))
            unit = np.repeat(np.arange(e - s), sizes[s:e])
            full = ~(np.isnan(x) | np.isnan(y))
            out[s:e] = _taus(unit[full], x[full], y[full], e - s)
        s = e
    return pd.Series(out).astype(object).where(~np.isnan(out), None)


def correlate_rows(df: DataFrame, key: str, a: str, b: str, method: str = "pearson", row_pairs: int = ROW_PAIRS) -> DataFrame:
    """(key, correlation) of two array columns per row.

    Rank methods take the rows of a repeated key as one series.  Tau of arrays of up to `row_pairs` under keys of their own
    is computed where the row is; longer ones are dealt out.
    """
    if method == "pearson":
        return df.select(key, correlate_arrays(F.col(a), F.col(b)).alias("correlation"))

    def dealt(rows):
        same = rows.filter(F.size(a) == F.size(b)).select(key, F.inline(F.arrays_zip(F.col(a), F.col(b))).alias("x", "y"))
        done = correlate(same, "x", "y", [key], method).select(key, "correlation")
        return match(rows.select(key), done, [key], "left")

    if method != "kendall":
        return dealt(df)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(F.size(a)).alias("m"))
    rows, longest = per_key.agg(F.max("n"), F.max("m")).first()
    if (rows or 0) > 1:
        return dealt(df)
    brief = F.coalesce(F.size(a) <= row_pairs, F.lit(True))
    here = (df if (longest or 0) <= row_pairs else df.filter(brief)).select(
        key, F.pandas_udf(_row_tau, "double")(F.col(a).cast("array<double>"), F.col(b).cast("array<double>")).alias("correlation"))
    return here if (longest or 0) <= row_pairs else here.unionByName(dealt(df.filter(~brief)))


def correlate_one_vs_all(df: DataFrame, series: str, key: str, value: str, chosen, method: str = "pearson") -> DataFrame:
    """(series, n, correlation) of one series with every other over shared keys."""
    one = df.filter(F.col(series) == F.lit(chosen)).select(key, F.col(value).alias("__chosen"))
    rest = df.filter(F.col(series) != F.lit(chosen))
    return correlate(rest.join(one, key), "__chosen", value, [series], method)


def correlation_matrix(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    """(a, b, correlation) of all column pairs, incomplete pairs dropped.

    Pearson takes one pass that adds up sums, squares, products and counts of every pair; its result depends on the
    number of columns only.  Rank methods rank every pair's complete rows, so each row is dealt out once per pair.
    """
    cols = list(cols)
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if method != "pearson":
        pair = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
                for i, a in enumerate(cols) for b in cols[i:]]
        rows = df.select(F.inline(F.array(*pair))).filter("x is not null and y is not null")
        done = correlate(rows, "x", "y", ["a", "b"], method).select("a", "b", "correlation")
        wanted = df.sparkSession.createDataFrame([(a, b) for a in cols for b in cols], "a string, b string")
        both = done.unionByName(done.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "correlation"))
        return wanted.join(both, ["a", "b"], "left")
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    shift = rows.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in cols]).first()
    means = np.array([shift[c] for c in cols])
    d = len(cols)

    def partial(batches):
        total = np.zeros((4, d, d))
        for pdf in batches:
            x = pdf.to_numpy(float) - means
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            m = known.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        yield pd.DataFrame({"at": np.arange(4 * d * d), "v": total.ravel()})

    sums = rows.mapInPandas(partial, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    t = np.zeros(4 * d * d)
    for row in sums:
        t[row["at"]] = row["v"]
    n, s, ss, p = t.reshape(4, d, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = p / n - (s / n) * (s.T / n)
        var = ss / n - (s / n) ** 2
        scale = np.sqrt(var * var.T)
        corr = np.where((n > 1) & (scale > 1e-300), cov / scale, np.nan)
    out = [(a, b, None if np.isnan(corr[i, j]) else float(corr[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(out, "a string, b string, correlation double")
