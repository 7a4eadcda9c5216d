"""Removing repeated byte strings by interval expansion on a Burrows-Wheeler transform (operator 7).

A string of `least` bytes has one minimizer: the k-mer with the smallest hash, the leftmost of equals.  Consecutive strings
with the same minimizer form a run.  Equal strings have equal minimizers, so runs whose minimizer is found twice or more are dealt
out by it, and each task compares its runs through a Burrows-Wheeler transform.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import free_name, small, store
from .components import runs, whole_groups

LEAST = 100
KMER = 24
POSITION_BITS = 19  # of a position inside a segment of a text
SEGMENT = (1 << POSITION_BITS) - 2 * LEAST
TRANSFORM_BYTES = 1 << 19  # runs are compared in lots of about so many bytes
HELD_STRINGS = 50_000  # runs that a task holds to collapse equal ones
HOT_STRINGS = 50_000  # beyond so many different runs of one minimizer its strings are dealt out singly
PARTS = 4  # kinds of contexts that candidates share
SEPARATOR = 0xFF  # never in UTF-8
LAST_ID = (1 << 63) - 1  # orders rows without an id after all others


def _hashes(data):
    """64-bit hash of every 24-byte string of `data`."""
    import numpy as np

    n = len(data) - 7
    words = np.empty(n, np.uint64)
    for o in range(8):
        own = data[o : o + (len(data) - o) // 8 * 8].view("<u8")
        words[o::8] = own[: len(words[o::8])]
    h = words[:-16] * np.uint64(0x9E3779B97F4A7C15)
    h += words[8:-8] * np.uint64(0xC2B2AE3D27D4EB4F)
    h += words[16:] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _minima(values, width: int):
    """Minimum of every `width` consecutive values, from minima towards both ends of blocks of that width."""
    import numpy as np

    n = len(values) - width + 1
    full = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(values)] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def text_runs(data, offsets, least: int):
    """Runs of the texts data[offsets[i]:offsets[i + 1]]: arrays (text, start, number of strings, minimizer's place in the run, its hash)."""
    import numpy as np

    mask = np.uint64((1 << POSITION_BITS) - 1)
    found = [[], [], [], [], []]
    lots, row, last = [], 0, len(offsets) - 1
    while row < last:
        # whole texts up to a segment's length, or the segments of a longer text
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SEGMENT, "right")) - 1)
        end = min(end, last)
        lo, hi = int(offsets[row]), int(offsets[end])
        while hi - lo >= least:
            stop = min(hi, lo + SEGMENT)
            lots.append((row, end, lo, stop))
            if stop == hi:
                break
            lo = stop - least + 1
        row = end
    for row, end, lo, hi in lots:
        part = np.ascontiguousarray(data[lo:hi])
        h = _hashes(part)
        low = _minima((h & ~mask) | np.arange(len(h), dtype=np.uint64), least - KMER + 1)
        at = (low & mask).astype(np.int64)
        # strings that would cross the end of a text
        valid = np.ones(len(at), bool)
        ends = offsets[row + 1 : end] - lo
        crossing = (ends[:, None] - np.arange(1, least)[None, :]).ravel()
        valid[crossing[(crossing >= 0) & (crossing < len(at))]] = False
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | ~valid[:-1]
        # a text starts anew even if the same hash position is not shared
        own = np.flatnonzero(valid & new)
        if not len(own):
            continue
        stops = np.flatnonzero(~valid | new)
        stops = np.append(stops, len(at))
        n = stops[np.searchsorted(stops, own, "right")] - own
        text = np.searchsorted(offsets, own + lo, "right") - 1
        found[0].append(text)
        found[1].append(own + lo - offsets[text])
        found[2].append(n)
        found[3].append(at[own] - own)
        found[4].append(h[at[own]].view(np.int64))
    if not found[0]:
        return [np.zeros(0, np.int64)] * 5
    return [np.concatenate(c) for c in found]


def _buffers(column):
    """Offsets and bytes of an Arrow string column."""
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def _suffixes(text, depth: int):
    """Suffix array, ordered by the first `depth` bytes or more, and its inverse, by prefix doubling from 8-byte words."""
    import numpy as np

    padded = np.concatenate([text, np.full(8, SEPARATOR, np.uint8)])
    n = len(text)
    key = np.zeros(n, np.uint64)
    for o in range(8):
        key = key << np.uint64(8) | padded[o : o + n].astype(np.uint64)
    done = 8
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, ranked[1:] != ranked[:-1]))
        if done >= depth or rank[order[-1]] == n - 1:
            break
        after = np.zeros(n, np.int64)
        after[:-done] = rank[done:] + 1
        key = rank.astype(np.uint64) << np.uint64(32) | after.astype(np.uint64)
        done *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def repeated(text, least: int):
    """Classes of equal `least`-byte strings of `text` that hold no separator: (positions, class), classes of two or more only.

    Breadth-first backward extension: the intervals of all strings of one length are extended by a byte to the left
    at once.  An interval's right end, if no shorter string has set it, is a common prefix of that length; only such intervals
    are extended again, and after strings of `least` bytes the search stops.  Ends that are still open lie inside classes.
    """
    import numpy as np

    n = len(text)
    order, place = _suffixes(text, least)
    before = np.where(order > 0, text[order - 1], SEPARATOR)  # the transform
    back = np.where(order > 0, place[order - 1], 0)
    first = text[order]
    shut = np.zeros(n + 1, bool)
    starts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    lo, hi = starts, np.append(starts[1:], n)
    shut[hi] = True
    shut[0] = True
    lo, hi = lo[first[lo] != SEPARATOR], hi[first[lo] != SEPARATOR]
    for _ in range(least - 1):
        size = hi - lo
        total = int(size.sum())
        if not total:
            break
        interval = np.repeat(np.arange(len(lo)), size)
        rows = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        byte = before[rows]
        keep = byte != SEPARATOR
        rows, interval, byte = rows[keep], interval[keep], byte[keep]
        if not len(rows):
            break
        to = back[rows]
        by = np.argsort(to)
        to, interval, byte = to[by], interval[by], byte[by]
        new = np.append(True, (to[1:] != to[:-1] + 1) | (interval[1:] != interval[:-1]) | (byte[1:] != byte[:-1]))
        lo = to[new]
        hi = to[np.append(np.flatnonzero(new)[1:], len(to)) - 1] + 1
        open_ = ~shut[hi]
        lo, hi = lo[open_], hi[open_]
        shut[hi] = True
    kind = np.cumsum(shut[:n]) - 1
    # strings across a separator are told from all others, but not from each other
    ends = np.append(np.flatnonzero(text == SEPARATOR), n)
    whole = ends[np.searchsorted(ends, order)] - order >= least
    many = (np.bincount(kind)[kind] > 1) & whole
    return order[many], kind[many]


def _merge(key, tie, start, end):
    """Unions of spans per (key, tie)."""
    import numpy as np

    by = np.lexsort((start, tie, key))
    key, tie, start, end = key[by], tie[by], start[by], end[by]
    new = np.append(True, (key[1:] != key[:-1]) | (tie[1:] != tie[:-1]))
    # spans of one length are ordered by their ends too; others are closed by the largest end so far
    group = np.cumsum(new)
    top = end.max() + 1 if len(end) else 1
    reach = np.maximum.accumulate(end + group * top) - group * top
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return key[at], tie[at], start[at], reach[np.append(at[1:], len(end)) - 1]


SPAN = "key long, tie long, start long, end long"


def _spans(key, tie, start, end):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (key, tie, start, end)], names=["key", "tie", "start", "end"])


def _runs_of(docs: DataFrame, least: int) -> DataFrame:
    """(key, tie, start, n, mer, hash) of every run of every text."""

    def run(batches):
        for b in batches:
            offsets, data = _buffers(b.column(2))
            text, *numbers, h = text_runs(data, offsets, least)
            ids = [pa.compute.take(b.column(i), pa.array(text)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, *(pa.array(x).cast(pa.int32()) for x in numbers), pa.array(h)], names=["key", "tie", "start", "n", "mer", "hash"])

    return docs.mapInArrow(run, "key long, tie long, start int, n int, mer int, hash long")


def _strings(docs: DataFrame, matched: DataFrame, least: int) -> DataFrame:
    """Bytes of the matched runs, and spans of those that repeat an earlier one of the same task (bytes null)."""
    rows = docs.join(matched.withColumnsRenamed({"key": "__key", "tie": "__tie"}), (F.col("key") == F.col("__key")) & (F.col("tie") == F.col("__tie")))

    def run(batches):
        import numpy as np

        seen: dict[bytes, tuple] = {}
        gone: list[tuple] = []

        def out(strings, spans):
            columns = [[], [], [], [], [], [], []]
            if strings:
                columns = [list(c) for c in zip(*((*at, s) for s, at in strings.items()))]
            if spans:
                key, tie, start, end = (c.tolist() for c in _merge(*(np.array(c, np.int64) for c in zip(*spans))))
                # spread over the tasks by their starts
                for column, more in zip(columns, (key, tie, start, end, [0] * len(key), start, [None] * len(key))):
                    column += more
            types = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["key", "tie", "start", "end", "mer", "hash", "bytes"])

        for b in small(batches):
            offsets, data = _buffers(b.column(2))
            borders = b.column(3).offsets.to_numpy()
            starts, ns, mers, hashes = (b.column(3).values.field(x).to_numpy() for x in ("start", "n", "mer", "hash"))
            for row, (key, tie) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                text = data[offsets[row] : offsets[row + 1]].tobytes()
                # repeated rows list their runs twice
                _, own = np.unique(starts[borders[row] : borders[row + 1]], return_index=True)
                own = own + borders[row]
                for start, n, mer, h in zip(starts[own].tolist(), ns[own].tolist(), mers[own].tolist(), hashes[own].tolist()):
                    end = start + n + least - 1
                    s, here = text[start:end], (key, tie, start, end, mer, h)
                    there = seen.setdefault(s, here)
                    if there > here:
                        seen[s], here, there = here, there, here
                    if there is not here and there[:3] != here[:3]:
                        gone.append(here[:4])
                if len(seen) > HELD_STRINGS or len(gone) > HELD_STRINGS:
                    yield out(seen, gone)
                    seen, gone = {}, []
        yield out(seen, gone)

    return rows.select("key", "tie", "text", "runs").mapInArrow(run, "key long, tie long, start long, end long, mer int, hash long, bytes binary")


def _candidates(strings: list[tuple[bytes, int]], least: int) -> list[int]:
    """Indices of the strings (bytes, place of the minimizer) of one minimizer that may share `least` bytes with another one.

    What two strings share holds their minimizer, at the same place; wherever that is, it also holds one of `PARTS` contexts
    around the minimizer in full.  Only strings with a context in common are compared.
    """
    step = -(-(least - KMER) // PARTS)
    seen: dict[tuple[int, bytes], list[int]] = {}
    for i, (s, m) in enumerate(strings):
        for k in range(PARTS):
            start, end = m - step * k, m + least - step * (k + 1)
            if start >= 0 and end <= len(s):
                seen.setdefault((k, s[start:end]), []).append(i)
    return sorted({i for own in seen.values() if len(own) > 1 for i in own})


def _compare(strings: DataFrame, least: int) -> DataFrame:
    """Spans of strings of `least` bytes that start earlier elsewhere, from runs partitioned and sorted by hash."""
    rows = strings.repartition("hash").sortWithinPartitions("hash").select("hash", "key", "tie", "start", "end", "mer", "bytes")

    def run(batches):
        import numpy as np

        lot: list[tuple] = []  # (bytes, key, tie, start)
        size = 0

        def transform():
            text = np.frombuffer(b"".join(s[0] + b"\xff" for s in lot), np.uint8)
            position, kind = repeated(text, least)
            begins = np.cumsum([0, *(len(s[0]) + 1 for s in lot)])
            own = np.searchsorted(begins, position, "right") - 1
            key, tie, start = (np.array([s[i] for s in lot], np.int64)[own] for i in (1, 2, 3))
            start = start + position - begins[own]
            by = np.lexsort((start, tie, key, kind))
            later = by[1:][kind[by][1:] == kind[by][:-1]]
            key, tie, start = key[later], tie[later], start[later]
            return _spans(*_merge(key, tie, start, start + least)) if len(key) else None

        for table in whole_groups(batches, ["hash"]):
            hashes = table.column("hash").to_numpy()
            gone = []
            columns = [table.column(c).to_pylist() for c in ("bytes", "key", "tie", "start", "end", "mer")]
            for s, e in runs(hashes):
                if e - s == 1:
                    continue
                first: dict[bytes, tuple] = {}
                for data, *here in zip(*(c[s:e] for c in columns)):
                    here = tuple(here)
                    there = first.setdefault(data, here)
                    if there > here:
                        first[data], here = here, there
                    if first[data] != here:
                        gone.append(here[:4])
                if len(first) > 1:
                    items = list(first.items())
                    near = [items[i] for i in _candidates([(data, at[4]) for data, at in items], least)]
                    lot += [(data, *at[:3]) for data, at in near]
                    size += sum(len(data) for data, _ in near)
                    if size >= TRANSFORM_BYTES:
                        if (spans := transform()) is not None:
                            yield spans
                        lot, size = [], 0
            if gone:
                yield _spans(*_merge(*(np.array(c, np.int64) for c in zip(*gone))))
        if lot and (spans := transform()) is not None:
            yield spans

    return rows.mapInArrow(run, SPAN)


def _singly(strings: DataFrame, least: int) -> DataFrame:
    """The same spans by grouping single strings of `least` bytes, for minimizers with too many different runs for a task."""
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.octet_length("bytes").cast("long") - least))
    one = strings.select("key", "tie", "start", "bytes", at.alias("at")).select("key", "tie", (F.col("start") + F.col("at")).alias("start"), F.expr(f"substring(bytes, cast(at + 1 as int), {least})").alias("window"))
    first = one.groupBy(F.col("window").alias("__window")).agg(F.min(F.struct("key", "tie", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = one.join(first, F.col("window") == F.col("__window")).filter(F.struct("key", "tie", "start") != F.col("first"))
    return later.select("key", "tie", "start", (F.col("start") + least).alias("end"))


def repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(key, tie, spans): per text with repeats the spans that are covered by strings which also start earlier.

    `docs` is (key, tie, text): keys order the texts, ties those of one key.  Rows with equal key and tie are one text.
    """
    if least < 2 * KMER:
        raise ValueError(f"strings of at least {2 * KMER} bytes")
    found = _runs_of(docs, least)
    # stored, so that both sides of the join are plain exchanges and a hot minimizer's partition can be split
    often = store(found.groupBy(F.col("hash").alias("__hash")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__hash"))
    matched = found.join(often, F.col("hash") == F.col("__hash")).groupBy("key", "tie").agg(F.collect_list(F.struct("start", "n", "mer", "hash")).alias("runs"))
    strings = store(_strings(docs, store(matched), least))
    whole = strings.filter("bytes is not null")
    hot = store(whole.groupBy(F.col("hash").alias("__hash")).count().filter(F.col("count") > HOT_STRINGS).select("__hash"))
    spans = strings.filter("bytes is null").select("key", "tie", "start", "end")
    if hot.count():
        spans = spans.unionByName(_singly(whole.join(hot, F.col("hash") == F.col("__hash"), "left_semi"), least))
        whole = whole.join(hot, F.col("hash") == F.col("__hash"), "left_anti")
    spans = store(spans.unionByName(_compare(whole, least)))
    return spans.groupBy("key", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _kept(text: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text, and its number of removed runs."""
    kept, n, reach = [], 0, 0
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if start > reach or not n:
            kept.append(text[reach:start])
            n, reach = n + 1, end
        else:
            reach = max(reach, end)
    return b"".join([*kept, text[reach:]]), n


def remove_repeats(docs: DataFrame, least: int = LEAST, as_text: bool = False) -> DataFrame:
    """`docs` with two columns more: the bytes that are left (or as text without characters cut in part) and the number of removed runs.

    The new columns come last; they are called `kept` and `spans`, with underscores before names that are taken.  Documents are ordered by
    doc_id, those without one last, those of one id by the hash of their texts; rows with equal id and text are one document and
    keep the same bytes.  A null text is empty.  Texts shorter than `least` bytes keep all.  Matches never cross documents, and strings are
    judged on the input.
    """
    names, (kept_as, spans_as) = docs.columns, (free_name(docs, n) for n in ("kept", "spans"))
    key, tie, data, of, of_tie, gone = (free_name(docs, n) for n in ("own_key", "own_tie", "own_text", "of_key", "of_tie", "gone"))
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), data: F.coalesce("text", F.lit("")).cast("binary")})
    keyed = keyed.withColumn(tie, F.xxhash64(data))
    texts = keyed.filter(F.octet_length(data) >= least).select(F.col(key).alias("key"), F.col(tie).alias("tie"), F.col(data).alias("text"))
    found = repeats(texts, least).toDF(of, of_tie, gone)
    rows = keyed.join(found, (F.col(key) == F.col(of)) & (F.col(tie) == F.col(of_tie)), "left").select(*names, data, gone)

    def cut(batches):
        at = len(names)
        for b in small(batches):
            kept, n = [], []
            for text, spans in zip(b.column(at).to_pylist(), b.column(at + 1).to_pylist()):
                left, count = _kept(text, spans)
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                n.append(count)
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(n, pa.int64())], names=[*names, kept_as, spans_as])

    added = [StructField(kept_as, StringType() if as_text else BinaryType()), StructField(spans_as, LongType())]
    return rows.mapInArrow(cut, StructType([*docs.schema.fields, *added]))


def digest(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of documents (doc_id, text)."""
    done = remove_repeats(docs.select("doc_id", "text"), least)
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return done.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).alias("n_removed"), F.col("spans").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def drop_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Documents without their repeated strings; a character that is cut in part goes too, and `n_chars`, if there is one, is counted anew."""
    done = remove_repeats(docs, least, as_text=True)
    kept, spans = done.columns[-2:]
    done = done.withColumn("text", F.when(F.col(spans) == 0, F.col("text")).otherwise(F.col(kept)))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)
