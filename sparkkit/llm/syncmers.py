"""Document fingerprints from closed syncmers (operator 5), in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import with_position

K = 5  # words of a syncmer
S = 2  # words of an inner string
KEPT = 64  # smallest syncmer hashes that are printed as fingerprint
# a word; the characters of a longer run count one by one, so texts without blanks have syncmers that do not depend on where the run starts
UNIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,16}(?![^\x20\x09-\x0D])|[^\x20\x09-\x0D]"
BAND = 8  # matches agree in position if their offsets differ by less than about this part of the longer text,
LEAST_BAND = 32  # or by less than about as many words
FIRST_ID = -(1 << 63)  # orders rows without an id before all others, so after them in descending order


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once: inside a lambda a repeated expression would be computed for every element."""
    return F.transform(F.array(value), body)[0]


def _hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), lambda w: F.xxhash64(w))


def _selected(h: Column, g: Column, make: Callable[[Column, Column], Column]) -> Column:
    """`make(i, hash)` of every closed syncmer i: the smallest of its inner strings g[i:i+K-S+1] is the first or the last."""
    last = K - S
    edge = lambda i: F.least(F.get(g, i), F.get(g, i + last))
    inner = lambda i: F.least(*[F.get(g, i + j) for j in range(1, last)])
    mer = lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(K)])
    return F.array_compact(F.transform(F.sequence(F.lit(0), F.size(h) - K), lambda i: F.when(edge(i) <= inner(i), make(i, mer(i)))))


def _of(text: Column, make: Callable[[Column, Column], Column], whole: Callable[[Column], Column]) -> Column:
    inner = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - S), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(S)]))
    chosen = lambda h: let(inner(h), lambda g: _selected(h, g, make))
    # fewer words than a syncmer has: the whole sequence; none: nothing
    return let(_hashes(text), lambda h: F.when(F.size(h) >= K, chosen(h)).when(F.size(h) > 0, whole(h)).otherwise(F.slice(whole(h), 1, 0)))


def anchors(text: Column) -> Column:
    """(position in words, hash) of every closed syncmer of a text, for positional matching.

    Whether a k-mer is chosen depends on its own words only, so equal passages have equal anchors in any context.
    """
    pair = lambda i, m: F.struct(i.cast("int").alias("pos"), m.alias("hash"))
    return _of(text, pair, lambda h: F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(h).alias("hash"))))


def table(text: Column) -> Column:
    """(hash, pos) of every distinct closed syncmer at its first place, by hash."""
    pair = lambda i, m: F.struct(m.alias("hash"), i.cast("int").alias("pos"))
    every = F.sort_array(_of(text, pair, lambda h: F.array(F.struct(F.xxhash64(h).alias("hash"), F.lit(0).alias("pos")))))
    return let(every, lambda s: F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["hash"] != x["hash"])))


def fingerprint(table: Column) -> Column:
    """The `KEPT` smallest hashes of a table as text, 16 lower-case hex digits each."""
    return F.concat_ws("", F.transform(F.slice(table, 1, KEPT), lambda x: F.lpad(F.lower(F.hex(x["hash"])), 16, "0")))


def offsets(a: Column, b: Column) -> Column:
    """How much later than in table `a` each common hash is in table `b`."""
    side = lambda t, n: F.transform(t, lambda x: F.struct(x["hash"].alias("hash"), F.lit(n).alias("side"), x["pos"].alias("pos")))
    # a hash is at most once on either side, so its two places are neighbours
    step = lambda m: F.transform(m, lambda x, i: F.when(F.get(m, i - 1)["hash"] == x["hash"], x["pos"] - F.get(m, i - 1)["pos"]))
    return F.array_compact(let(F.sort_array(F.concat(side(a, 0), side(b, 1))), step))


def _longest_run(values: Column) -> Column:
    """Length of the longest run of equal numbers in a sorted array."""
    start = F.struct(F.lit(None).cast("long").alias("v"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s, v):
        run = F.when(s["v"] == v, s["run"] + 1).otherwise(1)
        return F.struct(v.alias("v"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(values, start, step, lambda s: s["best"])


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct syncmers of two tables that are common and agree in position; two empty tables are alike.

    Common hashes vote for the offset between their places.  The band of offsets with most votes counts (two rows of bands, half a band
    apart, so offsets within half a band of each other always meet): an insertion moves few votes, passages in another order have another band.
    """
    end = F.greatest(*[F.coalesce(F.array_max(F.transform(t, lambda x: x["pos"])), F.lit(0)) for t in (a, b)])
    width = F.greatest(F.lit(LEAST_BAND), F.floor(end / BAND).cast("int"))
    votes = lambda o, shift: _longest_run(F.sort_array(F.transform(o["offset"], lambda x: F.floor((x + shift * F.floor(o["width"] / 2)) / o["width"]))))
    agreed = let(F.struct(offsets(a, b).alias("offset"), width.alias("width")), lambda o: F.when(F.size(o["offset"]) > 0, F.greatest(votes(o, 0), votes(o, 1))).otherwise(0))
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(let(agreed, lambda n: n / (total - n)))


def followers(docs: DataFrame) -> DataFrame:
    """(key, follower_of) per distinct id: the id after which it comes in descending order (the first comes after the last)."""
    placed = with_position(docs.select("key").distinct(), [], ["key"], "pos", hot=-1)
    n = F.lit(placed.count())
    before = placed.select(F.col("key").alias("follower_of"), F.pmod(F.col("pos") - 1, n).alias("__pos"))
    return placed.join(before, F.col("pos") == F.col("__pos")).select("key", "follower_of")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of documents (doc_id, text).

    The edited text has the last half of its characters replaced by the first as many (or all) of the next document's in
    descending doc_id.  Likeness is that of all syncmers with their positions, whatever the length; the fingerprint prints the smallest hashes.
    Null texts are empty; texts without words have an empty fingerprint.  Rows without an id come last in that order.  Rows with
    equal ids share their next document, and of them the smallest text by its hash is the next one of others.  A single document is its own next one.
    Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("doc_id", F.lit(FIRST_ID)).cast("long").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    after = followers(rows).withColumnRenamed("key", "__key")
    # both sides read the same columns, so the texts are shuffled once
    heads = rows.join(after, F.col("key") == F.col("__key"))
    heads = heads.select(F.col("follower_of").alias("__of"), "text", F.xxhash64("text", "doc_id").alias("tie"))
    heads = heads.groupBy("__of").agg(F.min_by("text", "tie").alias("next"))
    both = rows.join(heads, F.col("key") == F.col("__of")).withColumn("n_chars", F.char_length("text"))
    edited = F.expr("concat(substring(text, 1, cast(n_chars - floor(n_chars / 2) as int)), substring(next, 1, cast(floor(n_chars / 2) as int)))")
    both = both.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "text", edited.alias("edited"), "next")
    made = both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *[table(F.col(c)).alias(n) for c, n in (("text", "a"), ("edited", "b"), ("next", "c"))])
    return made.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("a")).alias("fingerprint"), fingerprint(F.col("b")).alias("edited_fingerprint"),
                       likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"))
