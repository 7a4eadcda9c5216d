"""Packing tokenised documents into sequences by linear grouping and best fit (operator 4)."""

from __future__ import annotations

import functools
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import read_ranks
from .common import numbered, small, store

CAPACITY = 1024
END_ID = 2
GROUPS = 1 << 16  # equal-cardinality groups of large lengths
SMALL = 128  # lengths up to this fill the gaps
# characters on which the two tokenizers' patterns agree; other texts take the slower one
PLAIN = re.compile(r"[^\x00-ʯ‐-‧]")
LONG_RUN = re.compile(r"\s{2000}|[^\s]{20000}")


class Ids:
    """Ids of texts by the tokenizer file at `path`, and of plain texts by the same byte-level vocabulary as ranks, which is faster.

    Each of the two is read when the first text needs it.
    """

    def __init__(self, path: str, ranks_path: str | None):
        self.path, self.ranks_path = path, ranks_path
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", ())]

    @functools.cached_property
    def slow(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @functools.cached_property
    def fast(self):
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(self.ranks_path), special_tokens={})

    def plain(self, text: str) -> bool:
        return self.ranks_path is not None and not PLAIN.search(text) and not LONG_RUN.search(text) and not any(s in text for s in self.special)

    def __call__(self, text: str):
        """Ids as numpy uint32; strings of special tokens in the text are what the tokenizer file makes of them."""
        import numpy as np

        if self.plain(text):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


@functools.cache
def ids_by(path: str, ranks_path: str | None) -> Ids:
    return Ids(path, ranks_path)


def token_ids(text: str | None, path: str, ranks_path: str | None):
    """Ids of a text and the end id as numpy uint32."""
    import numpy as np

    end = np.array([END_ID], "<u4")
    return np.concatenate([ids_by(path, ranks_path)(text), end]) if text else end


def pieces(docs: DataFrame, path: str, ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents as one piece, longer ones cut so that only the first piece may be shorter."""

    def cut(batches):
        for b in small(batches):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in b.columns)):
                ids = token_ids(text, path, ranks_path)
                first = len(ids) % capacity or capacity
                borders = [0, *range(first, len(ids) + 1, capacity)]
                rows += [(doc_id, i, s, e - s, zlib.crc32(ids[s:e].tobytes())) for i, (s, e) in enumerate(zip(borders, borders[1:]))]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def configuration(room: int, sizes: list[int], left: list[int]) -> list[tuple[int, int]]:
    """The multiset of `sizes` (descending, at most `left` of each) that fills `room` best: [(index, uses)].

    Sums are bits of an integer.  A sum belongs to the largest sizes that reach it, so small ones are kept for later.
    """
    reached, mask, steps = 1, (1 << (room + 1)) - 1, []
    for k, size in enumerate(sizes):
        if size > room or not left[k]:
            continue
        edge = reached
        for _ in range(min(left[k], room // size)):
            edge = (edge << size) & mask & ~reached
            if not edge:
                break
            steps.append((k, edge))
            reached |= edge
        if reached >> room:
            break
    total, uses = reached.bit_length() - 1, {}
    for k, edge in reversed(steps):
        if edge >> total & 1:
            uses[k] = uses.get(k, 0) + 1
            total -= sizes[k]
    return list(uses.items())


def plan_large(counts: dict[int, int], capacity: int, groups: int):
    """Place items, ranked by descending length, from a histogram (length -> count) only.

    Equal-cardinality groups of ranks are rounded up to their largest length.  A configuration holds the largest size left and
    what fills its room best, and is used as often as the counts allow.  Returns (rank starts, uses, first bins, number of bins): rank r in a
    range that starts at s goes to bin first + (r - s) % uses.  All of it is bounded by `groups`, whatever the number of items.
    """
    import numpy as np

    lengths = sorted(counts, reverse=True)
    ends = np.cumsum([counts[x] for x in lengths])
    total = int(ends[-1]) if lengths else 0
    each = -(-total // groups) or 1
    sizes, left, at = [], [], []
    for start in range(0, total, each):
        size, n = lengths[int(np.searchsorted(ends, start, "right"))], min(each, total - start)
        if sizes and sizes[-1] == size:
            left[-1] += n
        else:
            sizes.append(size)
            left.append(n)
            at.append(start)
    ranges, bins = [], 0
    for k in range(len(sizes)):
        while left[k]:
            left[k] -= 1
            uses = configuration(capacity - sizes[k], sizes, left)
            left[k] += 1
            used = dict(uses)
            used[k] = used.get(k, 0) + 1
            times = min(left[j] // u for j, u in used.items())
            for j, u in used.items():
                ranges.append((at[j], times, bins))
                at[j] += times * u
                left[j] -= times * u
            bins += times
    ranges.sort()
    return (*(np.array([r[i] for r in ranges], np.int64) for i in range(3)), bins)


def plan_small(counts: dict[int, int], gaps: dict[int, int], capacity: int):
    """Best fit of small items into gaps, from histograms (length -> count) and (gap -> bins) only.

    Runs of equal items go to runs of equal gaps at once, the longest first, each to the smallest gap that holds it; what fits
    nowhere opens bins.  Returns {length: (first items, gap classes, first bins)} and the number of new bins: item i in
    the range that starts at s goes to number first + i - s of the bins whose gap was the class (0: new bins).
    """
    import numpy as np

    ranges: dict[int, list[tuple[int, int, int]]] = {}  # gap now -> [(class, first bin, bins)]
    for gap, n in gaps.items():
        if gap > 0:
            ranges.setdefault(gap, []).append((gap, 0, n))
    plan, opened = {}, 0
    for length in sorted(counts, reverse=True):
        done, rows = 0, []
        while done < counts[length]:
            rest = counts[length] - done
            gap = min((g for g in ranges if g >= length), default=None)
            if gap is None:
                n = -(-rest // (capacity // length))
                ranges[capacity] = [(0, opened, n)]
                opened += n
                continue
            kind, first, n = ranges[gap].pop()
            taken = min(n, rest)
            rows.append((done, kind, first))
            done += taken
            if taken < n:
                ranges[gap].append((kind, first + taken, n - taken))
            if gap > length:
                ranges.setdefault(gap - length, []).append((kind, first, taken))
            if not ranges[gap]:
                del ranges[gap]
        plan[length] = tuple(np.array(c, np.int64) for c in zip(*rows))
    return plan, opened


def pack(docs: DataFrame, path: str, ranks_path: str | None = None, capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces of `docs` (doc_id, text).

    Lengths of at least `small` are planned by linear grouping, then the actual lengths are put in their places and what the
    sequences have left is filled with small pieces by best fit.  The driver sees histograms over at most `capacity` lengths only.
    Null and empty texts are the end id alone.  Repeated rows are packed as often as they come; a null doc_id stays null; no rows give no
    sequences.  Extra columns are ignored.
    """
    import numpy as np

    rows = store(numbered(pieces(docs, path, ranks_path, capacity), "length"))
    counts = dict(rows.groupBy("length").count().collect())  # at most `capacity` rows
    large = {x: n for x, n in counts.items() if x > small}
    starts, uses, firsts, bins = plan_large(large, capacity, groups)
    # rank of the first item of each length, longest first
    base = np.zeros(capacity + 1, np.int64)
    total = 0
    for x in sorted(large, reverse=True):
        base[x], total = total, total + large[x]
    names = rows.columns

    def place_large(batches):
        for b in batches:
            length, pos = (b.column(names.index(c)).to_numpy() for c in ("length", "pos"))
            rank = base[length] + pos
            k = np.searchsorted(starts, rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(firsts[k] + (rank - starts[k]) % uses[k])], names=[*names, "sequence_id"])

    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    placed = rows.filter(F.col("length") > small).mapInArrow(place_large, f"{schema}, sequence_id long")
    gaps = placed.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("gap")).filter("gap > 0")
    gaps = store(numbered(gaps, "gap").select("sequence_id", F.col("gap").alias("__gap"), F.col("pos").alias("__pos")))
    by_gap = dict(gaps.groupBy("__gap").count().collect())  # at most `capacity` rows
    plan, _ = plan_small({x: n for x, n in counts.items() if x <= small}, by_gap, capacity)

    def place_small(batches):
        for b in batches:
            length, pos = (b.column(names.index(c)).to_numpy() for c in ("length", "pos"))
            kind, at = np.empty(len(pos), np.int64), np.empty(len(pos), np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                items, kinds, first = plan[int(x)]
                k = np.searchsorted(items, pos[own], "right") - 1
                kind[own], at[own] = kinds[k], first[k] + pos[own] - items[k]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kind), pa.array(at)], names=[*names, "kind", "at"])

    filled = rows.filter(F.col("length") <= small).mapInArrow(place_small, f"{schema}, kind long, at long")
    filled = filled.join(gaps, (F.col("kind") == F.col("__gap")) & (F.col("at") == F.col("__pos")), "left")
    filled = filled.withColumn("sequence_id", F.coalesce("sequence_id", F.col("at") + bins)).select(*placed.columns)
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "part", "idx").rowsBetween(Window.unboundedPreceding, -1)
    both = placed.unionByName(filled)
    return both.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))
