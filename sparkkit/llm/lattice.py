"""Near-duplicate embeddings by E8 lattice hashing (operator 8)."""

from __future__ import annotations

import functools
from itertools import combinations, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .components import components, in_buckets, runs, whole_groups

LEAST_COSINE = 0.98
TABLES = 8
PROBES = 8  # neighbouring cells that a vector is also put into, per table
SCALE = 0.75  # of projected unit vectors, in units of the lattice
SEED = 8
CHUNK = 1024
PAIRS = 1 << 18  # pairs whose keys are compared at once


@functools.cache
def shortest():
    """The 240 shortest vectors of E8, whose ends are a cell's neighbours."""
    import numpy as np

    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            whole.append(v)
    half = [v for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + half)


def _nearest_d8(x):
    """Nearest points with whole coordinates of even sum: round, then move the worst coordinate if the sum is odd."""
    import numpy as np

    r = np.rint(x)
    off = x - r
    worst = np.abs(off).argmax(axis=1)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    r[odd, worst[odd]] += np.where(off[odd, worst[odd]] >= 0, 1.0, -1.0)
    return r


def nearest_e8(x):
    """Nearest E8 points: the nearer one of D8 and of D8 shifted by a half."""
    import numpy as np

    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


@functools.cache
def _projections(dim: int):
    import numpy as np

    return np.random.default_rng([SEED, dim]).standard_normal((TABLES, dim, 8)) * SCALE


def _cell(table: int, points, labels):
    """64-bit keys of lattice points (doubled, so whole)."""
    import numpy as np

    weights = np.random.default_rng([SEED, table, 1]).integers(1, 1 << 63, 9, dtype=np.uint64) | np.uint64(1)
    whole = np.rint(points * 2).astype(np.int64).view(np.uint64)
    key = (whole * weights[:8]).sum(axis=-1, dtype=np.uint64)
    key = key + labels.astype(np.int64).view(np.uint64).reshape(-1, *[1] * (key.ndim - 1)) * weights[8]
    key ^= key >> np.uint64(31)
    key *= np.uint64(0x9E3779B97F4A7C15)
    return (key ^ key >> np.uint64(29)).view(np.int64)


def cells(vectors, labels):
    """Keys of the home cells (n, tables) and of the neighbours nearest to each vector (n, tables, probes)."""
    import numpy as np

    homes = np.empty((len(vectors), TABLES), np.int64)
    probes = np.empty((len(vectors), TABLES, PROBES), np.int64)
    for t, matrix in enumerate(_projections(vectors.shape[1])):
        x = vectors @ matrix
        p = nearest_e8(x)
        near = np.argpartition(-((x - p) @ shortest().T), PROBES, axis=1)[:, :PROBES]
        homes[:, t] = _cell(t, p, labels)
        probes[:, t] = _cell(t, p[:, None, :] + shortest()[near], labels)
    return homes, probes


def _unit(column):
    """Unit vectors of a list column in double precision, as (dimension, rows, matrix) per dimension."""
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(offsets)
    for dim in np.unique(size).tolist():
        rows = np.flatnonzero(size == dim)
        m = values[offsets[rows][:, None] + np.arange(dim)]
        # scaled first, so that the squares of very large or small components stay finite
        m = m / np.abs(m).max(axis=1, keepdims=True)
        yield dim, rows, m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _met_first(bucket: int, a, b, homes, probes):
    """Of pairs (a, b), a with the smaller id, those that meet here first: in the first table they share, in a's cell if b has it."""
    import numpy as np

    out = np.zeros(len(a), bool)
    for s in range(0, len(a), PAIRS):
        x, y = a[s : s + PAIRS], b[s : s + PAIRS]
        mine = (homes[x] == homes[y]) | (homes[x][:, :, None] == probes[y]).any(axis=2)
        theirs = (homes[y][:, :, None] == probes[x]).any(axis=2)
        t = (mine | theirs).argmax(axis=1)
        at = np.arange(len(x))
        out[s : s + PAIRS] = np.where(mine[at, t], homes[x, t], homes[y, t]) == bucket
    return out


def _roots(n: int, a, b):
    """Smallest member of every row's component under the links (a, b)."""
    import numpy as np

    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def links(classes: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(id, links, root) from `classes` (id, label, vector, n): partial counts of linked vectors, and links to a component's member.

    A pair may meet in several cells; it is counted in the first only, found from both vectors' keys.
    """

    def hash_rows(batches):
        import numpy as np

        for b in batches:
            ids, labels = b.column(0).to_numpy(), b.column(1).to_numpy()
            for _, rows, m in _unit(b.column(2)):
                homes, probes = cells(m, labels[rows])
                keys = np.concatenate([homes[:, :, None], probes], axis=2).reshape(len(rows), -1)
                home = np.tile(np.arange(1 + PROBES) == 0, TABLES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(ids[rows], keys.shape[1])), pa.array(np.tile(home, len(rows)))], names=["bucket", "id", "home"])

    hashed = classes.select("id", "label", "vector").mapInArrow(hash_rows, "bucket long, id long, home boolean")
    met = in_buckets(hashed, "id", CHUNK, "home", classes).select("bucket", "i", "j", "c", "id", "home", "label", "vector", "n")

    def run(batches):
        import numpy as np

        for table in whole_groups(batches, ["bucket", "i", "j"]):
            bucket, i, j, c, ids, labels, n = (table.column(x).to_numpy() for x in ("bucket", "i", "j", "c", "id", "label", "n"))
            home = table.column("home").to_numpy()
            out = [[], [], []]
            where = np.empty((2, len(ids)), np.int64)  # of a row: its dimension's matrix and the row there
            units = []
            for dim, rows, m in _unit(table.column("vector")):
                where[:, rows] = [[len(units)], [0]]
                where[1, rows] = np.arange(len(rows))
                units.append(m)
            for s, e in runs(bucket, i, j):
                for d in range(len(units)):
                    rows = np.arange(s, e)[where[0, s:e] == d]
                    rows = rows[np.unique(ids[rows], return_index=True)[1]] if len(rows) > 1 else rows
                    if len(rows) < 2 or not home[rows].any():
                        continue
                    m = units[d][where[1, rows]]
                    near = m @ m.T >= least
                    a, b = np.nonzero(np.triu(near, 1))
                    x, y = rows[a], rows[b]
                    ok = (home[x] | home[y]) & (labels[x] == labels[y])
                    if i[s] != j[s]:
                        ok &= c[x] != c[y]
                    a, b = a[ok], b[ok]
                    if not len(a):
                        continue
                    ok = _met_first(bucket[s], a, b, *cells(m, labels[rows]))
                    a, b = a[ok], b[ok]
                    if not len(a):
                        continue
                    weight = n[rows]
                    count = np.bincount(a, weight[b], len(rows)) + np.bincount(b, weight[a], len(rows))
                    some = np.flatnonzero(count)
                    out[0].append(ids[rows][some])
                    out[1].append(count[some].astype(np.int64))
                    out[2].append(ids[rows][_roots(len(rows), a, b)[some]])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], names=["id", "links", "root"])

    return met.mapInArrow(run, "id long, links long, root long")


def near_duplicates(rows: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of `rows` (vec_id, embedding, label).

    Vectors are linked if their labels are equal and their cosine is at least `least`.  Equal vectors of a label collapse to one
    before the search and are linked to each other.  A row whose label is null, or whose vector is null, empty, zero or holds a null or
    non-finite component, is linked with nothing; vectors of different lengths are not linked.  Repeated rows count as
    vectors of their own.  A pair at the very border may be missed with a small probability (`TABLES`, `PROBES`); none below it is linked.
    """
    vector = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0.0)
    fine = F.coalesce(fine & F.col("label").isNotNull(), F.lit(False))
    valid, alone = rows.filter(fine), rows.filter(~fine)
    grouped = valid.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
    classes = store(grouped.withColumn("id", F.monotonically_increasing_id()))
    found = store(links(classes.select("id", "label", "vector", "n"), least))
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy(F.col("id").alias("__id")).agg(F.sum("links").alias("links"))
    named = classes.join(counts, F.col("id") == F.col("__id"), "left").join(joined, F.col("id") == F.col("node"), "left")
    named = store(named.select("label", "vector", "first", "n", "links", F.coalesce("root", "id").alias("root")))
    heads = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(heads, "root").select(F.col("label").alias("__label"), F.col("vector").alias("__vector"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    linked = valid.join(named, (F.col("label") == F.col("__label")) & (F.col("vector") == F.col("__vector"))).select("vec_id", "n_links", "component_id")
    both = linked.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
