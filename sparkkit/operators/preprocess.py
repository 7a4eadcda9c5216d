"""Feature preparation learned on training rows and applied unchanged afterwards."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import encode, nulls, scale
from ..functions.spec import Feature, check_spec

MAX_TERMS = 10_000  # a larger vocabulary needs max_features: every term is a column here


@dataclass
class Preprocessor:
    """Blocks in output order: one-hot, characters, unscaled hashes and term counts, scaled, passed through."""

    spec: list[Feature]
    scaler: str = "standard"
    missing: str = "zeros"
    scale_hashed: bool = True
    scale_vectors: bool = True
    scaler_args: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    characters: dict = field(default_factory=dict)
    vocabulary: dict = field(default_factory=dict)
    fills: dict = field(default_factory=dict)
    fitted: dict = field(default_factory=dict)

    def _features(self, *strategies: str) -> list[Feature]:
        return [f for f in self.spec if f.role == "feature" and f.strategy in strategies]

    def _vector_columns(self, f: Feature) -> list[str]:
        return [f"{f.name}_{i}_{encode.safe_name(w)}" for i, w in enumerate(self.vocabulary[f.name]["terms"])]

    def fit(self, df: DataFrame) -> Preprocessor:
        check_spec(self.spec)
        hot = [f.name for f in self._features("one hot encoding")]
        self.categories = encode.fit_categories(df, hot) if hot else {}
        self.characters = {f.name: encode.fit_characters(df, f.name) for f in self._features("text_similarity")}
        self.vocabulary = {}
        for f in self._features("count_vectorizing", "tf_idf"):
            options = {"max_features": None} | f.args
            texts = df.select(f.name).distinct().withColumn("__id", F.xxhash64(f.name))
            token_options = {k: v for k, v in options.items() if k in ("analyzer", "ngram_range", "stop_words")}
            texts, n_texts = encode.dealt_texts(texts, "__id", f.name)
            counts = encode.term_counts(texts, "__id", f.name, **token_options)
            unknown = set(f.args) - {"analyzer", "ngram_range", "stop_words", "min_df", "max_features"}
            if unknown:
                raise ValueError(f"{f.name}: unknown vectoriser arguments {sorted(unknown)}")
            found = encode.fit_vocabulary(counts, options.get("min_df", 1), options["max_features"]).limit(max(MAX_TERMS, options["max_features"] or 0) + 1).collect()
            if options["max_features"] is None and len(found) > MAX_TERMS:
                raise ValueError(f"{f.name}: more than {MAX_TERMS} terms; name max_features")
            ordered = sorted(found, key=lambda r: r["term"])
            self.vocabulary[f.name] = {
                "terms": [r["term"] for r in ordered], "df": [r["df"] for r in ordered], "n": n_texts, "options": token_options}
        numeric = [f.name for f in self._features("scaling", "none")]
        self.fills = nulls.missing_values(df, numeric, self.missing)
        scaled = self._scaled_columns()
        wide = self._wide(df)
        model = scale.fit_scaler(wide, scaled, self.scaler, **self.scaler_args)
        self.fitted = {"kind": type(model).__name__, "state": asdict(model)}
        return self

    def _scaled_columns(self) -> list[str]:
        out = []
        if self.scale_hashed:
            out += [f"{f.name}_{j}" for f in self._features("hashing") for j in range(f.args.get("n_features", 8))]
        if self.scale_vectors:
            out += [c for f in self._features("count_vectorizing", "tf_idf") for c in self._vector_columns(f)]
        return out + [f.name for f in self._features("scaling")]

    @property
    def columns(self) -> list[str]:
        """Names of the prepared features, in order."""
        out = [f"{c}_{v}" for c, values in self.categories.items() for v in values]
        out += [f"{c}_{ord(ch)}" for c, chars in self.characters.items() for ch in chars]
        scaled = self._scaled_columns()
        for f in self._features("hashing"):
            out += [f"{f.name}_{j}" for j in range(f.args.get("n_features", 8)) if f"{f.name}_{j}" not in scaled]
        for f in self._features("count_vectorizing", "tf_idf"):
            out += [c for c in self._vector_columns(f) if c not in scaled]
        return out + scaled + [f.name for f in self._features("none")]

    def _wide(self, df: DataFrame) -> DataFrame:
        """All encoded columns before scaling, next to the columns that are no features."""
        inputs = [f.name for f in self.spec if f.role == "feature"]
        known = {c: v for c, v in self.fills.items() if c in df.columns}
        out = nulls.fill_missing(df, known) if known else df
        parts = [F.when(F.col(c).cast("string") == v, 1.0).otherwise(0.0).alias(f"{c}_{v}")
                 for c, values in self.categories.items() for v in values]
        for c, chars in self.characters.items():
            parts += [x.cast("double").alias(f"{c}_{ord(ch)}") for x, ch in zip(encode.char_columns(c, chars), chars)]
        for f in self._features("hashing"):
            parts += encode.hash_columns(f.name, f.args.get("n_features", 8))
        for f in self._features("count_vectorizing", "tf_idf"):
            learned = self.vocabulary[f.name]
            if not learned["terms"]:
                continue
            terms = encode.tokens(F.coalesce(F.col(f.name), F.lit("")), **learned["options"])
            model = CountVectorizerModel.from_vocabulary(learned["terms"], "__terms", "__vector")
            out = model.transform(out.withColumn("__terms", terms)).withColumn(
                f"__v_{f.name}", vector_to_array("__vector")).drop("__terms", "__vector")
            values = F.col(f"__v_{f.name}")
            if f.strategy == "tf_idf":
                idf = F.array(*[F.log(F.lit((1.0 + learned["n"]) / (1.0 + d))) + 1 for d in learned["df"]])
                weights = F.zip_with(values, idf, lambda n, w: n * w)
                norm = F.sqrt(F.aggregate(weights, F.lit(0.0), lambda s, x: s + x * x))
                out = out.withColumn(f"__v_{f.name}", F.transform(
                    weights, lambda x: F.coalesce(F.try_divide(x, norm), F.lit(0.0))))
            parts += [F.col(f"__v_{f.name}").getItem(i).alias(c) for i, c in enumerate(self._vector_columns(f))]
        numeric = [F.col(f.name).cast("double").alias(f.name) for f in self._features("scaling", "none")]
        keep = [c for c in df.columns if c not in inputs]
        return out.select(*keep, *parts, *numeric)

    def _scaler(self):
        kind = {"Linear": scale.Linear, "Quantile": scale.Quantile}[self.fitted["kind"]]
        return kind(**self.fitted["state"])

    def transform(self, df: DataFrame, vector: str | None = None) -> DataFrame:
        """Other columns plus the prepared features; `vector` also assembles them."""
        wide = self._wide(df)
        model, scaled = self._scaler(), set(self._scaled_columns())
        keep = [c for c in wide.columns if c not in set(self.columns)]
        out = wide.select(*keep, *[model.apply(c).alias(c) if c in scaled else F.col(f"`{c}`") for c in self.columns])
        if vector is None:
            return out
        safe = {c: f"__f{i}" for i, c in enumerate(self.columns)}
        plain = out.select("*", *[F.col(f"`{c}`").alias(s) for c, s in safe.items()])
        done = VectorAssembler(inputCols=list(safe.values()), outputCol=vector, handleInvalid="keep").transform(plain)
        return done.drop(*safe.values())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Preprocessor:
        state = json.loads(text)
        state["spec"] = [Feature(**f) for f in state["spec"]]
        return Preprocessor(**state)


def feature_names(spec: Sequence[Feature]) -> list[str]:
    return [f.name for f in spec if f.role == "feature"]
