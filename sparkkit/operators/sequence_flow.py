"""The supervised flow on ordered series: lagged samples, a lagged or stationary target, walking forward.

A sample of row t holds the features of the rows t-lags .. t (or t-lags .. t-1) and, with `lag_target`, the targets
before these.  Predictions of future rows are inputs of later ones, so steps follow one another, but every few steps are
one distributed job over all series: the state of a series is its last few rows.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spec import Feature, names_with
from ..plans.durable import scratch_folder, stored as keep
from ..plans.ordered import HOT_GROUP_ROWS, bounded_frame, match, with_position
from . import estimators as est
from . import flow, metrics
from .sequence import top_k

PREVIOUS = "previous_y"
BLOCK = 8  # steps of one job
ONE = "__series"  # constant key of a table that is one series


@dataclass
class Stationary:
    """What the model sees instead of the target: its logarithm, or its difference to earlier targets, and/or scaled values."""

    how: str | None = None  # log or difference
    lags: tuple[int, ...] = (1,)
    scale: bool = False
    center: float = 0.0
    spread: float = 1.0

    def __post_init__(self):
        if self.how not in (None, "log", "difference"):
            raise ValueError(f"{self.how!r} is not log or difference")

    @property
    def reach(self) -> int:
        return max(self.lags) if self.how == "difference" else 0

    def raw(self, y: Column, earlier: dict[int, Column]) -> Column:
        """Before scaling; `earlier` has the targets so many rows back."""
        if self.how == "log":
            return F.when(y > 0, F.log(y))
        for k in self.lags if self.how == "difference" else ():
            y = y - earlier[k]
        return y

    def scaled(self, z: Column) -> Column:
        return (z - self.center) / self.spread if self.scale else z

    def invert(self, z: Column, earlier: dict[int, Column]) -> Column:
        y = z * self.spread + self.center if self.scale else z
        if self.how == "log":
            return F.exp(y)
        for k in self.lags if self.how == "difference" else ():
            y = y + earlier[k]
        return y


@dataclass
class SequenceModel:
    """A fitted flow on lagged samples and what is needed to build these."""

    model: flow.FlowModel
    spec: list[Feature]
    by: list[str]
    order: list[str]
    lags: int
    lag_target: bool
    current_sample: bool
    target: Stationary
    result: DataFrame | None = None
    metrics: DataFrame | None = None
    hot: int = HOT_GROUP_ROWS
    extra: dict = field(default_factory=dict)

    @property
    def y(self) -> str:
        return names_with(self.spec, ["target"])[0]

    @property
    def features(self) -> list[str]:
        return names_with(self.spec, ["feature"])

    @property
    def kind(self) -> str:
        return est.CATALOGUE[self.model.estimator][0]

    @property
    def steps_back(self) -> list[int]:
        """How many rows back the inputs of a sample lie, oldest first."""
        return _steps_back(self.lags, self.current_sample)

    @property
    def history(self) -> int:
        """Known rows that a series needs before its first prediction."""
        targets = max(self.steps_back) + 1 + self.target.reach if self.lag_target else self.target.reach
        return max(max(self.steps_back), targets)

    def samples(self, df: DataFrame) -> DataFrame:
        """Rows with all their lags: (by..., order..., target, inputs...)."""
        return _samples(df, self.spec, self.by, self.order, self.lags, self.lag_target, self.current_sample, self.target, self.kind, self.hot)

    def predict_known(self, df: DataFrame) -> DataFrame:
        """(by..., order..., prediction) one step ahead of every row from what is known before it; rows without all lags have a null."""
        rows = self.samples(df)
        scored = self.model.score(rows)
        if self.kind == "regressor":
            earlier = {k: F.col(f"__y{k}") for k in self.target.lags}
            scored = scored.withColumn("prediction", self.target.invert(F.col("prediction"), earlier))
        keys = [*self.by, *self.order]
        return match(df.select(*keys), scored.select(*keys, "prediction"), keys, "left")

    def predict(self, df: DataFrame, proba: bool = False) -> DataFrame:
        """(by..., order..., prediction) of the rows after the last known target of their series, each from those before it.

        With `proba`, also `probabilities` ('No: 0.912, Yes: 0.088').  A series with too few known rows has null predictions.
        """
        return _walk(self, df, proba)


def _steps_back(lags: int, current_sample: bool) -> list[int]:
    return [*range(lags, 0, -1), *([0] if current_sample or not lags else [])]


def _name(column: str, back: int) -> str:
    return f"{column}__t{back}"


def _inputs(spec: Sequence[Feature], lags: int, lag_target: bool, current_sample: bool, kind: str, scale_lag: bool) -> list[Feature]:
    """Features of a sample: all those of the oldest row first."""
    own = [f for f in spec if f.role == "feature"]
    if lag_target:
        strategy = "one hot encoding" if kind == "classifier" else "scaling" if scale_lag else "none"
        own.append(Feature(PREVIOUS, dtype="str" if kind == "classifier" else "float", strategy=strategy))
    return [replace(f, name=_name(f.name, back)) for back in _steps_back(lags, current_sample) for f in own]


def _samples(df, spec, by, order, lags, lag_target, current_sample, target: Stationary, kind, hot) -> DataFrame:
    y, features = names_with(spec, ["target"])[0], names_with(spec, ["feature"])
    value = F.col(y).cast("string" if kind == "classifier" else "double")
    rows = df.select(*by, *order, *features, value.alias("__y"))
    back = sorted({0, *target.lags}) if target.how == "difference" else [0]
    rows = bounded_frame(rows, by, order, max(back), 0, lambda w: {f"__y{k}": F.lag("__y", k).over(w) for k in back if k} | {"__n": F.lag(F.lit(1), max(back)).over(w)}, hot)
    earlier = {k: F.col(f"__y{k}") for k in back if k}
    z = F.col("__y") if kind == "classifier" else target.scaled(target.raw(F.col("__y"), earlier))
    rows = rows.withColumn("__z", z).filter("__n is not null").drop("__n")
    steps = _steps_back(lags, current_sample)
    # targets come from one row earlier than the features of the same name
    reach = max(steps) + (1 if lag_target else 0)

    def columns(w):
        out = {_name(f, k): F.lag(f, k).over(w) if k else F.col(f) for k in steps for f in features}
        if lag_target:
            out |= {_name(PREVIOUS, k): F.lag("__z", k + 1).over(w) for k in steps}
        return out | {"__full": F.lag(F.lit(1), reach).over(w) if reach else F.lit(1)}

    done = bounded_frame(rows, by, order, reach, 0, columns, hot)
    return done.filter("__full is not null").drop("__full", *features)


def fit_sequence(df: DataFrame, spec: Sequence[Feature], estimator: str, by: Sequence[str], order: Sequence[str], name: str = "model", *,
                 lags: int = 0, lag_target: bool = False, current_sample: bool = True, stationary: str | None = None,
                 stationarity_lags: Sequence[int] = (1,), scale_target: bool = False, scale_lag_target: bool = True, test_size: float = 0.0,
                 hot: int = HOT_GROUP_ROWS, **options) -> SequenceModel:
    """Fit any estimator of the catalogue on the lagged rows of series (by) in their order.

    `order` is unique inside a series.  Rows without a target are no samples.  With `test_size`, the last share of the known rows of
    every series is held out and predicted by walking forward from the others; `result` and `metrics` describe that, and the
    returned model is fitted on all rows.  Other options are those of `flow.fit`.
    """
    spec, by, order = list(spec), list(by), list(order)
    if names_with(spec, ["identifier"]):
        raise ValueError("rows of a series are known by `by` and `order`; the specification has no identifier")
    y, kind = names_with(spec, ["target"])[0], est.CATALOGUE[estimator][0]
    if kind == "classifier" and (stationary or scale_target):
        raise ValueError("classes cannot be scaled or made stationary")
    if not by:
        df, by = df.withColumn(ONE, F.lit(0)), [ONE]
    known = df.filter(F.col(y).isNotNull())

    def train(part: DataFrame) -> SequenceModel:
        target = Stationary(stationary, tuple(stationarity_lags), scale_target)
        shape = (by, order, lags, lag_target, current_sample)
        samples = _samples(part, spec, *shape, target, kind, hot)
        if scale_target:
            row = samples.agg(F.avg("__z").alias("m"), F.stddev_pop("__z").alias("s")).first()
            target.center, target.spread = row["m"] or 0.0, row["s"] or 1.0
            samples = _samples(part, spec, *shape, target, kind, hot)
        inputs = _inputs(spec, lags, lag_target, current_sample, kind, scale_lag_target and not scale_target)
        fitted = flow.fit(samples, [*inputs, Feature("__z", "target", "str" if kind == "classifier" else "float")], estimator, name, test_size=0, **options)
        return SequenceModel(fitted, spec, by, order, lags, lag_target, current_sample, target, hot=hot)

    model = train(known)
    model.result = model.model.result
    if test_size:
        rows = with_position(known, by, order, "__pos", hot)
        sizes = known.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) * (1 - test_size)).alias("__train"))
        rows = keep(match(rows, sizes, by).withColumn("__test", F.col("__pos") >= F.col("__train")).drop("__pos", "__train"))
        asked = rows.withColumn(y, F.when(~F.col("__test"), F.col(y)))
        keys = [*by, *order]
        found = train(rows.filter(~F.col("__test"))).predict(asked)
        truth = rows.filter("__test").select(*keys, F.col(y).alias("y"))
        tested = match(truth, found, keys).filter("prediction is not null").persist()
        score = flow._score(tested, "y", kind)
        model.metrics = (metrics.classifier_metrics if kind == "classifier" else metrics.regressor_metrics)(tested, "y", "prediction", name)
        model.extra["tested"] = tested
        stamp = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None, microsecond=0)
        text = f"{'accuracy' if kind == 'classifier' else 'r2'} (walk-forward hold-out)"
        model.result = df.sparkSession.createDataFrame([(name, "model fitted", stamp, text, score)], model.result.schema)
    return model


def _walk(model: SequenceModel, df: DataFrame, proba: bool) -> DataFrame:
    """Block by block over the future rows: `BLOCK` steps of every series are scored in one job, each from the ones before.

    The rows are stored by block, so a job reads its own ones only; what a block hands on is stored too, so a lost executor costs one block.
    """
    by, order, y, hot = model.by, model.order, model.y, model.hot
    if by == [ONE] and ONE not in df.columns:
        df = df.withColumn(ONE, F.lit(0))
    text = model.kind == "classifier"
    value = F.col(y).cast("string" if text else "double")
    rows = df.select(*by, *order, *model.features, value.alias("__y"))
    place = F.struct(*order)
    last = rows.filter("__y is not null").groupBy(*by).agg(F.max(place).alias("__last"))
    rows = match(rows, last, by, "left")
    ahead = F.col("__last").isNull() | (place > F.col("__last"))
    future = with_position(rows.filter(ahead).drop("__last", "__y"), by, order, "__step", hot)
    own = F.struct("__step", F.struct(*order).alias("at"), F.struct(*[F.col(f).alias(f"f{i}") for i, f in enumerate(model.features)], F.lit(0).alias("none")).alias("now"))
    # at most BLOCK rows in a list
    future = future.groupBy(*by, F.floor(F.col("__step") / BLOCK).alias("__block")).agg(F.sort_array(F.collect_list(own)).alias("__rows"))
    folder = scratch_folder(df.sparkSession)
    future.repartition("__block", *by).write.partitionBy("__block").parquet(folder)
    stored = df.sparkSession.read.schema(future.schema).parquet(folder)
    blocks = (stored.agg(F.max("__block")).first()[0] + 1) if stored.take(1) else 0
    kind = "string" if text else "double"
    if not blocks:
        empty = df.limit(0).select(*by, *order, F.lit(None).cast(kind).alias("prediction"), *([F.lit("").alias("probabilities")] if proba else []))
        return empty.drop(ONE)

    need = max(model.history, 1)
    width = need + model.target.reach  # z of a known row needs rows before it
    lagged = top_k(rows.filter(~ahead), by, [F.desc(o) for o in order], width).drop("row_no")
    past = F.sort_array(F.collect_list(F.struct(*order, *[F.col(f).alias(f"f{i}") for i, f in enumerate(model.features)], F.col("__y").alias("y"))))
    state = lagged.groupBy(*by).agg(past.alias("__raw"))
    raw = lambda i: F.get("__raw", i)["y"]
    if text:
        z = raw
    else:
        z = lambda i: model.target.scaled(model.target.raw(raw(i), {k: raw(i - F.lit(k)) for k in model.target.lags}))
    kept = [f"f{i}" for i in range(len(model.features))]
    made = F.transform(F.sequence(F.lit(0), F.size("__raw") - 1), lambda i: F.struct(*[F.get("__raw", i)[f].alias(f) for f in kept], raw(i).alias("y"), z(i).alias("z")))
    state = keep(state.select(*by, made.alias("__state")).filter(F.size("__state") >= need))
    back = lambda k, f: F.try_element_at("__state", F.lit(-k))[f]

    results = []
    for b in range(blocks):
        now = match(stored.filter(F.col("__block") == b).drop("__block"), state, by, "left").withColumn("__found", F.array())
        first = True
        for i in range(BLOCK):
            row = F.get("__rows", F.lit(i))
            inputs = {}
            for k in model.steps_back:
                inputs |= {_name(f, k): back(k, f"f{j}") if k else row["now"][f"f{j}"] for j, f in enumerate(model.features)}
                if model.lag_target:
                    inputs[_name(PREVIOUS, k)] = back(k + 1, "z")
            scored = model.model.score(now.select(*by, "__rows", "__state", "__found", *[c.alias(n) for n, c in inputs.items()]))
            done = F.col("__state").isNotNull() & row.isNotNull()
            found = F.col("prediction") if text else model.target.invert(F.col("prediction"), {k: back(k, "y") for k in model.target.lags})
            cell = F.struct(F.when(done, found).alias("prediction"), *([F.when(done, _shown(model)).alias("probabilities")] if proba else []))
            longer = F.concat("__state", F.array(F.struct(*[row["now"][f].alias(f) for f in kept], found.alias("y"), F.col("prediction").alias("z"))))
            shifted = F.when(done, F.slice(longer, F.greatest(F.size(longer) - width + 1, F.lit(1)), F.lit(width))).otherwise(F.col("__state"))
            now = scored.select(*by, "__rows", shifted.alias("__state"), (F.array(cell) if first else F.concat("__found", F.array(cell))).alias("__found"))
            first = False
        now = keep(now)
        each = now.select(*by, F.inline(F.arrays_zip("__rows", "__found")))
        each = each.filter("__rows is not null").select(*by, *[F.col("__rows")["at"][o].alias(o) for o in order], "__found.*")
        results.append(each)
        state = now.filter("__state is not null").select(*by, "__state")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out.drop(ONE)


def _shown(model: SequenceModel) -> Column:
    from ..functions.parse import format_proba

    return format_proba(F.array(*[F.lit(v) for v in model.model.fitted.labels]), F.col("probability"))
