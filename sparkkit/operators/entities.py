"""Named entities: dictionary and pattern extraction, annotation alignment, a trainable tagger.

Offsets are 0-based code points, the end is exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .estimators import class_labels, index_of
from .split import split_texts

# a capitalised word; no place is tried twice, so a text of capitals only needs no stack
_CAPITAL = r"[\p{Lu}\p{Lt}][\p{L}\p{M}\p{N}_]*+(?:['’-][\p{L}][\p{L}\p{M}\p{N}_]*+)*+"
# fixed values: pattern and description of the built-in entity types
PATTERNS = {
    "EMAIL": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "E-mail addresses"),
    "URL": (r"https?://[^\s<>\"']+", "Web addresses"),
    "MONEY": (r"[$€£]\s?\d[\d,]*(?:\.\d+)?", "Monetary values, including unit"),
    "DATE": (r"\d{4}-\d{2}-\d{2}", "Absolute or relative dates or periods"),
    "CARDINAL": (r"\d+", "Numerals that do not fall under another type"),
    "NAME": (rf"(?<![\p{{L}}\p{{M}}\p{{N}}_]){_CAPITAL}(?:\h++{_CAPITAL})*+", "Capitalised words that follow each other"),
}
WORDS = 50_000  # words of a result batch
# a dictionary of so many entries and such phrases, in characters, goes to every task; a larger one meets all words in a shuffle
ENTRIES, LONGEST = 100_000, 500


def _positions(text: str, pattern: str):
    """Array of (start, end) of all matches of a pattern that has no groups: the matches and the text
    between them have known lengths, so adding these up gives the offsets without Python."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    between = F.split(F.col(text), pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,entity:string>>").alias("out"))

    def step(s, pair):
        begin = s["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["hit"].alias("entity"))
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
    return F.aggregate(pairs, start, step, lambda s: s["out"])


def pattern_entities(df: DataFrame, key: str, text: str, patterns: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """(key, entity, start, end, type, description) of pattern matches; whole texts, no Python."""
    patterns = PATTERNS if patterns is None else patterns
    rows = F.array(*[
        F.struct(F.lit(n).alias("type"), F.lit(d).alias("description"), _positions(text, p).alias("spans")) for n, (p, d) in patterns.items()])
    each = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.inline(rows))
    spans = each.select("key", "type", "description", F.inline("spans"))
    return spans.select("key", "entity", "start", "end", "type", "description")


_WORD = re.compile(r"\w{2,}|\w|[^\w\s]")


def _wanted_batches(batches: Iterator[pa.RecordBatch], first: dict[str, int], size: int = WORDS) -> Iterator[pa.RecordBatch]:
    """Words of (key, text) rows that may begin a phrase, with the text from there on if the phrase is longer than the word.

    `first` has the first words in small letters and how many characters their phrases need, 0 for the word alone.  Only letters of
    ASCII are sure to have the same small ones here and in Spark, so words with others are all handed on.
    """
    longest = max(first.values(), default=0)
    for batch in batches:
        keys, texts = batch.column("key"), batch.column("text")
        at, found = [], [[], [], [], []]

        def taken() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(found, kinds))], ["key", "word", "start", "end", "ahead"])

        for row in range(batch.num_rows):
            text = texts[row].as_py()
            for m in _WORD.finditer(text):
                word = m.group()
                reach = first.get(word.lower()) if word.isascii() else longest
                if reach is None:
                    continue
                at.append(row)
                for column, value in zip(found, (word, m.start(), m.end(), text[m.start() : m.start() + reach + 1] if reach else None)):
                    column.append(value)
                if len(at) == size:
                    yield taken()
                    at, found = [], [[], [], [], []]
        if at:
            yield taken()


def _word_batches(batches: Iterator[pa.RecordBatch], size: int = WORDS) -> Iterator[pa.RecordBatch]:
    """Words of (key, text) rows, no more than `size` at a time, whatever the texts of a batch."""
    for batch in batches:
        keys, texts = batch.column("key"), batch.column("text")
        at, found = [], [[], [], [], []]

        def taken() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(found, kinds))], ["key", "pos", "word", "start", "end"])

        for row in range(batch.num_rows):
            for i, m in enumerate(_WORD.finditer(texts[row].as_py())):
                at.append(row)
                for column, value in zip(found, (i, m.group(), m.start(), m.end())):
                    column.append(value)
                if len(at) == size:
                    yield taken()
                    at, found = [], [[], [], [], []]
        if at:
            yield taken()


def words(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, word, start, end): words of every text with their offsets, read by mapInArrow
    because a running offset over tens of thousands of words is quadratic as an array expression."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(_word_batches, f"key {kind}, pos long, word string, start int, end int")


def gazetteer_entities(df: DataFrame, key: str, text: str, gazetteer: DataFrame) -> DataFrame:
    """(key, entity, start, end, type, description) of dictionary phrases; `gazetteer` has
    (phrase, type, description).

    Phrases and texts meet in an equi-join on the first word; the whole phrase is then compared with
    the text at that place.  A dictionary of up to ENTRIES rows is sent to the texts, of which only words that
    may begin a phrase leave a task; a larger one is not, since dictionaries can be of any size.
    """
    first = F.regexp_extract(F.lower("phrase"), r"(?U)\w{2,}|\w|[^\w\s]", 0)
    entries = gazetteer.filter("phrase is not null and phrase <> ''").select(first.alias("__first"), "phrase", "type", "description").distinct()
    single, size = F.lower("phrase") == F.col("__first"), F.length("phrase")
    known = entries.withColumn("__reach", F.when(single, 0).otherwise(size)).limit(ENTRIES + 1).collect()
    if len(known) > ENTRIES or any(e["__reach"] > LONGEST for e in known):
        return _shuffled_entities(df, key, text, entries)
    reach: dict[str, int] = {}
    for e in known:
        reach[e["__first"]] = max(reach.get(e["__first"], 0), e["__reach"])
    listed = df.sparkSession.createDataFrame([tuple(e)[:-1] for e in known], entries.schema)
    kind = df.schema[key].dataType.simpleString()
    rows = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = rows.mapInArrow(lambda batches: _wanted_batches(batches, reach), f"key {kind}, word string, start int, end int, ahead string")
    met = found.withColumn("__first", F.lower("word")).join(F.broadcast(listed), "__first")
    entity, after = F.substring("ahead", F.lit(1), size), F.substring("ahead", size + 1, F.lit(1))
    longer = F.col("key").isNotNull() & (F.lower(entity) == F.lower("phrase")) & ~after.rlike(r"^[\p{L}\p{N}_]")
    return met.filter(single | longer).select("key", F.when(single, F.col("word")).otherwise(entity).alias("entity"), "start",
                                              F.when(single, F.col("end")).otherwise(F.col("start") + size).alias("end"), "type", "description")


def _shuffled_entities(df: DataFrame, key: str, text: str, entries: DataFrame) -> DataFrame:
    """As `gazetteer_entities`, for entries of any number and length."""
    found = words(df, key, text).withColumn("__first", F.lower("word"))
    single = entries.filter(F.lower("phrase") == F.col("__first"))
    plain = found.join(single, "__first").select("key", F.col("word").alias("entity"), "start", "end", "type", "description")
    longer = entries.filter(F.lower("phrase") != F.col("__first"))
    size = F.length("phrase")
    starts = found.join(longer, "__first").select("key", "start", "phrase", "type", "description")
    texts = df.select(F.col(key).alias("key"), F.col(text).alias("__text"))
    held = starts.join(texts, "key").withColumn("entity", F.substring(F.col("__text"), F.col("start") + 1, size))
    after = F.substring(F.col("__text"), F.col("start") + size + 1, F.lit(1))
    matched = held.filter((F.lower("entity") == F.lower("phrase")) & ~after.rlike(r"^[\p{L}\p{N}_]"))
    multi = matched.select("key", "entity", "start", (F.col("start") + size).alias("end"), "type", "description")
    return plain.unionByName(multi)


def drop_contained_spans(spans: DataFrame, by: Sequence[str] = ("key",), weak: str | None = None) -> DataFrame:
    """Spans that no other span of the text contains; of equal spans one stays.

    In order of start (longest first) a span is contained exactly if an earlier one ends at or
    after its end, so one running maximum per text replaces a comparison of all pairs.  Spans whose
    column `weak` is true give way to others and hold none but their like.
    """
    # a window partition is one text, whose spans are bounded by the text itself
    order = ["start", F.desc("end"), *([weak] if weak else []), "type"]
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(w)
    if weak:
        reach = F.when(F.col(weak), reach).otherwise(F.max(F.when(~F.col(weak), F.col("end"))).over(w))
    return spans.withColumn("__reach", reach).filter(F.col("__reach").isNull() | (F.col("__reach") < F.col("end"))).drop("__reach")


def extract_entities(df: DataFrame, key: str, text: str, gazetteer: DataFrame | None = None, patterns: dict | None = None) -> DataFrame:
    """(key, entity, start, end, type, description): patterns and dictionary, longest spans first.

    A run of capitals is only a likely name, so it is left out inside another span and takes none away.
    """
    found = pattern_entities(df, key, text, patterns).withColumn("__weak", F.col("type") == "NAME")
    if gazetteer is not None:
        found = found.unionByName(gazetteer_entities(df, key, text, gazetteer).withColumn("__weak", F.lit(False)))
    return drop_contained_spans(found, weak="__weak").drop("__weak")


def describe_types(spans: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Add the description of each type from a (type, description) table."""
    return spans.drop("description").join(descriptions.select("type", "description"), "type", "left")


# ---- annotations ---------------------------------------------------------------------------


def align_annotations(df: DataFrame, text: str = "text", entity: str = "entity", kind: str = "entity_type", order: str | None = None) -> DataFrame:
    """(text_id, start, end, type) of every word-bounded occurrence of the annotated entities.

    If an entity has several types in a text, its i-th occurrence takes the i-th type (the last one
    when they run out); otherwise its one type counts for all occurrences.  An empty type marks a
    text without entities.
    """
    ids = df.select(F.sha2(F.col(text), 256).alias("text_id"), F.col(text).alias("__text"), F.col(entity).alias("entity"), F.col(kind).alias("type"),
                    (F.col(order) if order else F.lit(0)).alias("__order"))
    known = ids.filter("entity is not null and entity <> '' and type is not null and type <> ''")
    lists = known.groupBy("text_id", "entity").agg(F.transform(F.sort_array(F.collect_list(F.struct("__order", "type"))), lambda s: s["type"]).alias("types"),
                                                   F.first("__text").alias("__text"))
    bounded = F.concat(F.lit(r"(?U)(?<!\w)\Q"), F.replace(F.col("entity"), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?!\w)"))
    between = F.split(F.col("__text"), bounded, -1)
    size = F.length("entity")
    gaps = F.transform(F.slice(between, F.lit(1), F.size(between) - 1), F.length)
    starts = F.aggregate(gaps, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                         lambda s, g: F.struct((s["at"] + g + size).alias("at"), F.concat(s["out"], F.array(s["at"] + g)).alias("out")), lambda s: s["out"])
    placed = lists.select("text_id", "entity", "types", F.posexplode(starts).alias("i", "start"))
    several = F.size(F.array_distinct("types")) > 1
    pick = F.when(several, F.get("types", F.least(F.col("i"), F.size("types") - 1))).otherwise(F.col("types")[0])
    return placed.select("text_id", "start", (F.col("start") + F.length("entity")).alias("end"), pick.alias("type"))


# ---- tagger --------------------------------------------------------------------------------


@dataclass
class Tagger:
    """Token classifier over hashed features of a word and its neighbours."""

    name: str
    labels: list[str]
    model: object
    n_features: int

    def token_labels(self, df: DataFrame, key: str, text: str) -> DataFrame:
        tokens = _token_features(words(df, key, text), self.n_features)
        out = self.model.transform(tokens)
        names = F.array(*[F.lit(v) for v in self.labels])
        return out.select("key", "pos", "word", "start", "end", F.get(names, F.col("prediction").cast("int")).alias("tag"))

    def extract(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """(key, entity, start, end, type): runs of tokens of one type."""
        return assemble_spans(self.token_labels(df, key, text))


def _token_features(tokens: DataFrame, n_features: int) -> DataFrame:
    """A window partition is one text: the neighbours of a word."""
    w = Window.partitionBy("key").orderBy("pos")
    lower = F.lower("word")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("word", r"\p{Lu}", "X"), r"\p{Ll}", "x"), r"\d", "0")
    named = tokens.withColumns({
        "__before": F.coalesce(F.lag(lower).over(w), F.lit("<start>")), "__after": F.coalesce(F.lead(lower).over(w), F.lit("<end>"))})
    parts = F.array(F.concat(F.lit("w="), lower), F.concat(F.lit("b="), F.col("__before")), F.concat(F.lit("a="), F.col("__after")),
                    F.concat(F.lit("s="), F.regexp_replace(shape, r"(.)\1+", "$1+")), F.concat(F.lit("p="), F.substring(lower, 1, 3)),
                    F.concat(F.lit("e="), F.substring(lower, -3, 3)))
    listed = named.withColumn("__parts", parts).drop("__before", "__after")
    return HashingTF(inputCol="__parts", outputCol="features", numFeatures=n_features, binary=True).transform(listed).drop("__parts")


def assemble_spans(tagged: DataFrame) -> DataFrame:
    """Join token tags (B-x, I-x, O) to spans; a window partition is one text."""
    w = Window.partitionBy("key").orderBy("pos")
    kind = F.when(F.col("tag") != "O", F.substring("tag", 3, 200))
    rows = tagged.withColumn("type", kind)
    opens = F.col("type").isNotNull() & (F.col("tag").startswith("B-") | F.lag("type").over(w).isNull() | (F.lag("type").over(w) != F.col("type")))
    numbered = rows.withColumn("__span", F.sum(opens.cast("int")).over(w)).filter("type is not null")
    return numbered.groupBy("key", "__span", "type").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("entity")).select(
        "key", "entity", "start", "end", "type")


def token_gold(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """Tokens with their BIO tag; spans of a text do not contain each other.

    The spans of a text travel as one array with its tokens, so no range join is needed.
    """
    lists = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end", "type")).alias("__spans"))
    joined = tokens.join(lists, "key", "left")
    hit = F.get(F.filter("__spans", lambda s: (s["start"] <= F.col("start")) & (F.col("end") <= s["end"])), F.lit(0))
    tag = F.when(hit.isNull(), "O").when(hit["start"] == F.col("start"), F.concat(F.lit("B-"), hit["type"])).otherwise(F.concat(F.lit("I-"), hit["type"]))
    return joined.withColumn("tag", tag).drop("__spans")


def train_tagger(df: DataFrame, key: str, text: str, spans: DataFrame, epochs: int = 100, test: float = 0.3, seed: int = 42, name: str = "tagger",
                 n_features: int = 1 << 12) -> tuple[Tagger, DataFrame]:
    """A tagger and its report (model_name, subset, metric, value): scores per subset and losses."""
    texts = split_texts(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", test, seed).persist()
    tokens = _token_features(words(texts, "key", "text"), n_features)
    gold = token_gold(tokens, spans).join(texts.select("key", "subset"), "key").persist()
    labels = class_labels(gold, "tag")
    train = gold.filter("subset = 'train'").withColumn("label", index_of("tag", labels))
    model = LogisticRegression(maxIter=epochs, regParam=1e-4, featuresCol="features", labelCol="label", family="multinomial").fit(train)
    tagger = Tagger(name, labels, model, n_features)
    names = F.array(*[F.lit(v) for v in labels])
    tagged = model.transform(gold).withColumn("tag", F.get(names, F.col("prediction").cast("int")))
    found = assemble_spans(tagged.select("key", "pos", "word", "start", "end", "tag")).join(texts.select("key", "subset"), "key")
    wanted = spans.join(texts.select("key", "subset"), "key")
    report = evaluate_spans(wanted, found, name).unionByName(loss_rows(gold.sparkSession, model, name))
    return tagger, report


def evaluate_spans(gold: DataFrame, found: DataFrame, model_name: str = "model") -> DataFrame:
    """(model_name, subset, metric, value): precision, recall and F-score of exact spans."""
    on = ["subset", "key", "start", "end", "type"]
    g = gold.select(*on).distinct().withColumn("__g", F.lit(1))
    p = found.select(*on).distinct().withColumn("__p", F.lit(1))
    counts = g.join(p, on, "full").groupBy("subset").agg(
        F.count("__g").alias("g"), F.count("__p").alias("p"), F.sum(F.when(F.col("__g").isNotNull() & F.col("__p").isNotNull(), 1).otherwise(0)).alias("tp"))
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("p")).cast("double"), zero)
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("g")).cast("double"), zero)
    fscore = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), zero)
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), c.alias("value")) for n, c in (("Precision", precision), ("Recall", recall), ("F-score", fscore))])
    return counts.select(F.lit(model_name).alias("model_name"), "subset", F.inline(rows))


def loss_rows(spark, model, model_name: str = "model") -> DataFrame:
    """Loss per training iteration as `Epoch n` rows."""
    losses = [float(v) for v in model.summary.objectiveHistory] if model.hasSummary else []
    rows = [(model_name, "train", f"Epoch {i}", v) for i, v in enumerate(losses)]
    return spark.createDataFrame(rows, "model_name string, subset string, metric string, value double")


def compare_taggers(a: DataFrame, b: DataFrame) -> DataFrame:
    """(type_a, type_b, n): types two models give to the same spans; null where one found nothing."""
    left = a.select("key", "start", "end", F.col("type").alias("type_a")).distinct()
    right = b.select("key", "start", "end", F.col("type").alias("type_b")).distinct()
    return left.join(right, ["key", "start", "end"], "full").groupBy("type_a", "type_b").agg(F.count(F.lit(1)).alias("n"))


def entity_baskets(spans: DataFrame) -> DataFrame:
    """(group, item) rows for association rules: the entities of a text."""
    return spans.select(F.col("key").alias("group"), F.lower("entity").alias("item")).distinct()
