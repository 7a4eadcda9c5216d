"""Quality grades by ordinal cumulative-link regression on hashed text (operator 9)."""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .common import free_name, small, unit

BITS = 18  # weights are hashed to so many bits
SAMPLE = 12_000  # labelled documents that the model is fitted on, at most
GRADES = 3  # 0 toxic, 1 poor, 2 good
LEAST_TAIL = 0.5
STEPS = 150
RATE = 0.1
PENALTY = 2e-4
SEED = 9
EDGES = ".,;:!?\"'()[]{}<>*#%&$|-_=+~`/\\"
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def features(text: str | None):
    """Hashed features of a whole text: (indices, values).

    Every distinct word counts alike, however long the text is; the shapes of the words (letter case and what follows the letters) and the
    share of repeated words count by their share.
    """
    import numpy as np
    from xxhash import xxh32_intdigest

    words = TOKEN.findall(text) if text else []
    mask = (1 << BITS) - 1
    if not words:
        return np.array([xxh32_intdigest("empty", SEED) & mask], np.int32), np.ones(1, np.float32)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    shapes: dict[str, int] = {}
    plain = set()
    for w, n in counts.items():
        bare = w.strip(EDGES)
        plain.add(bare.lower())
        case = "A" if bare.isupper() and len(bare) > 1 else "a" if bare else "-"
        at = w.find(bare) + len(bare) if bare else 0
        after = w[at:]
        for shape in (case + after[:3], f"{case} {min(2, len(after))}"):
            shapes[shape] = shapes.get(shape, 0) + n
    plain.discard("")
    n = len(words)
    index = [xxh32_intdigest(w, SEED) & mask for w in plain]
    value = [1.0] * len(index)
    index += [xxh32_intdigest("\n" + s, SEED) & mask for s in shapes]
    value += [20.0 * k / n for k in shapes.values()]
    index.append(xxh32_intdigest(f"\n\nvaried {min(9, 10 * len(counts) // n)} {min(6, n.bit_length() // 2)}", SEED) & mask)
    value.append(1.0)
    return np.array(index, np.int32), np.array(value, np.float32)


class Model(NamedTuple):
    weights: object  # float32 array of 2**BITS, shared by all grades
    thresholds: object  # ascending

    def grade(self, text: str | None) -> tuple[float, float]:
        """Expected grade and probability of the best grade."""
        import numpy as np

        index, value = features(text)
        above = 1 / (1 + np.exp(np.clip(self.thresholds - float(self.weights[index] @ value), -60, 60)))
        return float(above.sum()), float(above[-1])


def fit(index, value, starts, grades, n_grades: int = GRADES) -> Model:
    """Fit by Adam on all rows: P(grade > k) = logistic(score - threshold k), thresholds kept in order by positive steps.

    Row i has features index[starts[i]:starts[i + 1]].  Without rows everything gets the best grade.
    """
    import numpy as np

    n = len(grades)
    if not n:
        return Model(np.zeros(1 << BITS, np.float32), np.full(n_grades - 1, -60.0))
    row = np.repeat(np.arange(n), np.diff(starts))
    # thresholds start where the counts of the grades put them
    share = np.clip(np.array([(grades <= k).sum() for k in range(n_grades - 1)]) + 0.5, 0, n) / (n + 1.0)
    theta = np.log(share / (1 - share))
    steps = np.append(theta[0], np.log(np.maximum(np.diff(theta), 1e-3)))
    w = np.zeros(1 << BITS)
    used = np.unique(index)
    at = np.searchsorted(used, index)
    w = np.zeros(len(used))
    params = [w, steps]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        w, steps = params
        score = np.bincount(row, w[at] * value, n)
        theta = steps[0] + np.append(0.0, np.cumsum(np.exp(steps[1:])))
        cut = np.concatenate([[-np.inf], theta, [np.inf]])
        hi = 1 / (1 + np.exp(-np.clip(cut[grades + 1] - score, -60, 60)))
        lo = 1 / (1 + np.exp(-np.clip(cut[grades] - score, -60, 60)))
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p / n, lo * (1 - lo) / p / n
        g_score = d_hi - d_lo
        g_w = np.bincount(at, g_score[row] * value, len(used)) + PENALTY * w
        g_theta = np.array([-(d_hi[grades == k].sum()) + d_lo[grades == k + 1].sum() for k in range(n_grades - 1)])
        tail = np.cumsum(g_theta[::-1])[::-1]
        g_steps = np.append(tail[0], tail[1:] * np.exp(steps[1:]))
        for i, g in enumerate((g_w, g_steps)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    w, steps = params
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w
    return Model(weights, steps[0] + np.append(0.0, np.cumsum(np.exp(steps[1:]))))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from labels (doc_id, quality, toxic): 0 toxic, 1 of low quality, 2 neither; rows with a null are left out."""
    grade = F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull()).select("doc_id", grade.alias("grade"))


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, n_grades: int = GRADES) -> Model:
    """Fit on at most `sample` rated documents (doc_id, grade), drawn by the hash of their ids.

    The sample is the only thing that reaches the driver, as hashed features.
    """
    import numpy as np

    drawn = ratings.groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(unit(SEED, F.col("doc_id")), "doc_id").limit(sample)
    # at most `sample` rows of two numbers
    rated = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "grade")

    def extract(batches):
        for b in small(batches):
            both = [features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(2).cast(pa.int32()), pa.array([x[0] for x in both], pa.list_(pa.int32())), pa.array([x[1] for x in both], pa.list_(pa.float32()))],
                names=["doc_id", "grade", "index", "value"])

    got = rated.mapInArrow(extract, "doc_id long, grade int, index array<int>, value array<float>").toArrow().sort_by("doc_id")
    lists = got.column("index").combine_chunks()
    if not got.num_rows:
        return fit(np.zeros(0, int), np.zeros(0), np.zeros(1, int), np.zeros(0, int), n_grades)
    starts = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
    return fit(lists.flatten().to_numpy(), got.column("value").combine_chunks().flatten().to_numpy(), starts, got.column("grade").to_numpy(), n_grades)


def score(docs: DataFrame, model: Model, least: float = LEAST_TAIL) -> DataFrame:
    """Add `expected_grade`, `p_best` and `kept` (p_best of at least `least`) to all documents.

    A null, empty or blank text is judged as a text without words.  Repeated rows get equal grades.  If the table has a column of one of these
    names, the new one gets underscores before it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights
    new = [free_name(docs, n) for n in ("expected_grade", "p_best", "kept")]
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        for b in small(batches):
            both = [shared.value.grade(t) for t in b.column(at).to_pylist()]
            expected, best = [x[0] for x in both], [x[1] for x in both]
            added = [pa.array(expected, pa.float64()), pa.array(best, pa.float64()), pa.array([p >= least for p in best], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*names, *new])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(new[0], DoubleType()), StructField(new[1], DoubleType()), StructField(new[2], BooleanType())]))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose probability of the best grade is at least one half, with their columns."""
    scored = score(docs, train(docs, graded(labels)))
    return scored.filter(F.col(f"`{free_name(docs, 'kept')}`")).select(*[f"`{c}`" for c in docs.columns])
