"""SimHash near-duplicates found through pivot distance tables (operator 6)."""

from __future__ import annotations

from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, small, store
from .components import components, in_buckets, runs, whole_groups

SHINGLE = 3
SEED = 42
MAX_BITS = 3
# widths of the blocks of a fingerprint; two of five are equal if at most three bits differ
BLOCKS = (13, 13, 13, 13, 12)
N_PIVOTS = 12
CHUNK = 4096


def fingerprint(text: str | None, words_each: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles; 0 without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_each:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[: -words_each] + 1).tolist()]
        hashes = [xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[words_each - 1 :].tolist())]
    h = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches):
        import numpy as np

        for b in small(batches):
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def pivots():
    """Reference fingerprints: zero and hashes of small numbers."""
    import numpy as np
    from xxhash import xxh64_intdigest

    return np.array([0, *(xxh64_intdigest(b"", i) for i in range(1, N_PIVOTS))], np.uint64)


def linked(fps, max_bits: int):
    """For every fingerprint (ascending, distinct) the index of the smallest one it is linked to, itself included.

    Components grow from their smallest member.  A member looks only at what no component holds yet: rows whose
    distance to the first pivot fits are a slice of the sorted table, the largest difference to any pivot discards
    most of them, and the survivors are verified.
    """
    import numpy as np

    table = np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    root = np.full(len(fps), -1)
    left = order  # not held yet, by distance to the first pivot
    for start in range(len(fps)):
        if root[start] >= 0:
            continue
        root[start] = start
        todo = [start]
        while todo:
            x = todo.pop()
            keys = table[left, 0]
            lo, hi = np.searchsorted(keys, table[x, 0] - max_bits), np.searchsorted(keys, table[x, 0] + max_bits, "right")
            near = left[lo:hi]
            near = near[root[near] < 0]
            near = near[(np.abs(table[near] - table[x]) <= max_bits).all(axis=1)]
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= max_bits]
            if len(near):
                root[near] = start
                todo.extend(near.tolist())
                left = left[root[left] < 0]
    return root


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all fingerprints `fp` with `max_bits` or fewer differing bits.

    Every bucket holds the fingerprints with equal bits in some blocks; by the pigeonhole principle
    two linked ones share a bucket.  A bucket returns links to the smallest members of its components, not its pairs.
    """
    free = len(BLOCKS) - max_bits
    if free < 1:
        raise ValueError(f"at most {len(BLOCKS) - 1} bits")
    offsets = [sum(BLOCKS[:i]) for i in range(len(BLOCKS))]
    keys = []
    for t, chosen in enumerate(combinations(range(len(BLOCKS)), free)):
        key = F.lit(t).cast("long")
        for i in chosen:
            block = F.shiftrightunsigned("fp", offsets[i]).bitwiseAND(F.lit((1 << BLOCKS[i]) - 1))
            key = F.shiftleft(key, BLOCKS[i]).bitwiseOR(block)
        keys.append(key)
    rows = in_buckets(distinct.select("fp", F.explode(F.array(*keys)).alias("bucket")), "fp", CHUNK).select("bucket", "i", "j", "fp")

    def run(batches):
        import numpy as np

        for table in whole_groups(batches, ["bucket", "i", "j"]):
            *keys, fp = (table.column(c).to_numpy() for c in ("bucket", "i", "j", "fp"))
            a, b = [], []
            for s, e in runs(*keys):
                own = np.unique(fp[s:e])
                root = linked(own.view(np.uint64), max_bits)
                out = np.flatnonzero(root != np.arange(len(own)))
                a.append(own[out])
                b.append(own[root[out]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of documents (doc_id, text), one row for each of theirs.

    Texts with equal fingerprints collapse before the search.  A null, empty or blank text has fingerprint zero and
    is linked like any other; a null doc_id never names a component (a component of such rows only has a null one);
    repeated rows are repeated in the result.  Extra columns are ignored.
    """
    prints = store(fingerprints(docs, words))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = store(components(near_links(distinct.select("fp"), max_bits)))
    rooted = distinct.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = store(rooted)
    heads = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(heads, "root").select(F.col("fp").alias("__fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("__fp")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of every group whose fingerprints of `words`-word shingles are linked at `max_bits` or fewer differing bits.

    The row with the smallest (doc_id, hash of the text) stays, ids before null.  Every row is judged by its own text, so rows of one id with
    different texts are different documents; rows with equal id and text are one.  Blank and null texts have fingerprint zero.
    """
    # a row is known by its id, if it has one, and its text
    none, rid, text = F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.coalesce("text", F.lit(""))
    rows = docs.select(none.alias("none"), rid.alias("id"), F.md5(text).alias("h"), "text")

    def run(batches):
        import numpy as np

        for b in small(batches):
            fps = np.array([fingerprint(t, words) for t in b.column(3).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fps.view(np.int64))], names=["none", "id", "h", "fp"])

    heads = F.min(F.struct("none", "id", "h")).alias("head")
    distinct = store(rows.mapInArrow(run, "none boolean, id long, h string, fp long").groupBy("fp").agg(heads))
    found = store(components(near_links(distinct.select("fp"), max_bits)))
    rooted = distinct.join(found, F.col("fp") == F.col("node"), "left")
    keep = rooted.groupBy(F.coalesce("root", "fp")).agg(F.min("head").alias("head"))
    keep = keep.select(F.col("head.none").alias("__none"), F.col("head.id").alias("__id"), F.col("head.h").alias("__h"))
    own = [free_name(docs, n) for n in ("keep_none", "keep_id", "keep_hash")]
    marked = docs.withColumns(dict(zip(own, (none, rid, F.md5(text)))))
    same = [F.col(a) == F.col(b) for a, b in zip(own, ("__none", "__id", "__h"))]
    return marked.join(keep, same, "left_semi").dropDuplicates(own).drop(*own)
