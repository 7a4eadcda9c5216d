"""Alignment of two tokenizers by coalesced byte intervals (operator 11)."""

from __future__ import annotations

import functools
import hashlib
import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_chars, encoded
from .common import small, store
from .packing import ids_by

SPACE = "▁"
# characters of the texts that are aligned at once
HELD = 1 << 17


class Vocabularies:
    """Both tokenizers of a worker, the bytes of their tokens, and all pairs of ids that can end together.

    Tokens that end at the same byte are suffixes of one another, so the pairs follow from the vocabularies alone: their number
    is bounded by the lengths of the tokens, whatever the corpus.  `pairs` holds them sorted, as id of A times `width` plus id of B.
    """

    def __init__(self, a_path: str, b_path: str, ranks_path: str | None = None):
        import numpy as np
        import sentencepiece

        self.a = ids_by(a_path, ranks_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {c: b for b, c in enumerate(byte_chars())}
        with open(a_path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            # special tokens are never made
            self.a_bytes[i] = b"" if token in self.a.special else bytes(back[c] for c in token)
        size = self.b.get_piece_size()
        self.b_bytes = [b""] * size
        for i in range(size):
            if self.b.is_byte(i):
                self.b_bytes[i] = bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
            elif not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i)):
                self.b_bytes[i] = self.b.id_to_piece(i).replace(SPACE, " ").encode()
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.width = size
        self.pairs = np.array(sorted(self._suffix_pairs()), np.int64)
        # decimal ids with what follows them: inside a group, at the end of its side
        self.shown = [f"{i}," for i in range(len(self.a_bytes))] + [f"{i}|" for i in range(len(self.a_bytes))]
        self.shown += [f"{i}," for i in range(size)] + [f"{i};" for i in range(size)]

    def _suffix_pairs(self):
        found = set()
        by_a, by_b = {}, {}
        for by, table in ((by_a, self.a_bytes), (by_b, self.b_bytes)):
            for i, token in enumerate(table):
                if token:
                    by.setdefault(token, []).append(i)
        for table, others, swap in ((self.a_bytes, by_b, False), (self.b_bytes, by_a, True)):
            for i, token in enumerate(table):
                for start in range(len(token)):
                    for j in others.get(token[start:], ()):
                        found.add(j * self.width + i if swap else i * self.width + j)
        return found


    def encode_a(self, text: str):
        """Ids of A, in which strings of special tokens are ordinary text."""
        import numpy as np

        if self.a.plain(text):
            return self.a(text)
        self.a.slow.encode_special_tokens = True
        return np.array([i for _, ids, _, _ in encoded(self.a.slow, [text]) for i in ids], "<u4")


@functools.cache
def vocabularies(a_path: str, b_path: str, ranks_path: str | None = None) -> Vocabularies:
    return Vocabularies(a_path, b_path, ranks_path)


def coalesce(starts, ends, side):
    """Order of all tokens by (start, side), and for each place in it whether a group begins there.

    A group begins where a start reaches the largest end so far.
    """
    import numpy as np

    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    new = np.ones(len(order), bool)
    new[1:] = starts[order][1:] >= reach[:-1]
    return order, new


def overlaps(a_start, a_end, b_start, b_end):
    """Indices (i, j) of all A and B tokens that share bytes, inside their groups; both sides are ascending and gapless."""
    import numpy as np

    first = np.searchsorted(b_end, a_start, "right")
    n = np.maximum(np.searchsorted(b_start, a_end, "left") - first, 0)
    i = np.repeat(np.arange(len(a_start)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def tokens(v: Vocabularies, texts):
    """Ids of both tokenizers for each text as numpy arrays, empty where a side's bytes are not a space and the text."""
    import numpy as np

    texts = [t or "" for t in texts]
    none = np.zeros(0, np.int64)
    a, b = [], []
    for text, ids_b in zip(texts, v.b.encode(texts, num_threads=1) if texts else []):
        want = b" " + text.encode()
        ids_a = v.encode_a(" " + text) if text else none
        same = text and all(b"".join(map(table.__getitem__, ids)) == want for table, ids in ((v.b_bytes, ids_b), (v.a_bytes, ids_a.tolist())))
        a.append(ids_a if same else none)
        b.append(np.array(ids_b, np.int64) if same else none)
    return a, b


def groups(v: Vocabularies, a, b):
    """Tokens of all texts laid end to end: ids and ends of both sides, then (side, order, new) of all, and where each text begins in `order`."""
    import numpy as np

    n_a, n_b = (np.array([len(x) for x in s], np.int64) for s in (a, b))
    ids_a, ids_b = (np.concatenate([*s, np.zeros(0, np.int64)]).astype(np.int64) for s in (a, b))
    end_a, end_b = np.cumsum(v.a_len[ids_a]), np.cumsum(v.b_len[ids_b])
    starts = np.concatenate([end_a - v.a_len[ids_a], end_b - v.b_len[ids_b]])
    side = np.repeat(np.array([0, 1], np.int8), [len(ids_a), len(ids_b)])
    order, new = coalesce(starts, np.concatenate([end_a, end_b]), side)
    return ids_a, ids_b, end_a, end_b, side, order, new, np.cumsum(n_a + n_b) - n_a - n_b


def _rows(batches, held: int = HELD):
    """Rows (doc_id, text) of batches, about `held` characters at a time."""
    for b in small(batches):
        size, start = 0, 0
        lengths = [len(t or "") for t in b.column(1).to_pylist()]
        for i, n in enumerate(lengths):
            size += n
            if size >= held or i == len(lengths) - 1:
                yield b.slice(start, i + 1 - start)
                size, start = 0, i + 1


def aligned(docs: DataFrame, a_path: str, b_path: str, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, pairs): per document its sizes, the hash of its groups and its links as numbers of `Vocabularies.pairs`."""

    def run(batches):
        import numpy as np

        v = vocabularies(a_path, b_path, ranks_path)
        size_a, size_b = len(v.a_bytes), len(v.b_bytes)
        for rows in _rows(batches):
            a, b = tokens(v, rows.column(1).to_pylist())
            ids_a, ids_b, end_a, end_b, side, order, new, first = groups(v, a, b)
            group = np.cumsum(new) - 1
            # tokens by (group, side), as they are printed; the last one of a side is followed by | or ;
            printed = np.lexsort((side[order], group))
            own, kind = order[printed], side[order][printed]
            last = np.ones(len(own), bool)
            last[:-1] = (kind[1:] != kind[:-1]) | (group[printed][1:] != group[printed][:-1])
            ids = np.concatenate([ids_a, ids_b])[own]
            shown = np.where(kind == 0, ids + size_a * last, 2 * size_a + ids + size_b * last)
            # links: an end that both sides have
            _, i, j = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
            pair = np.searchsorted(v.pairs, ids_a[i] * v.width + ids_b[j]).astype(np.int32)
            borders = [*first.tolist(), len(own)]
            n_a = np.array([len(x) for x in a], np.int64)
            ends = np.searchsorted(i, np.cumsum(n_a))  # links of the texts up to each one
            names, hashes, n_groups = v.shown, [], []
            for k, (s, e) in enumerate(zip(borders, borders[1:])):
                text = "".join(map(names.__getitem__, shown[s:e].tolist()))[:-1]
                hashes.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
                n_groups.append(int(new[s:e].sum()))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(pair))
            columns = [rows.column(0), pa.array(n_a), pa.array([len(x) for x in b], pa.int64()), pa.array(n_groups, pa.int64()), pa.array(hashes, pa.string()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<int>")


def pair_counts(links: DataFrame, n_pairs: int) -> DataFrame:
    """(pair, n): how many links of the column `pairs` hold each pair; tasks add up their own ones first."""

    def run(batches):
        import numpy as np

        total = np.zeros(n_pairs, np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_pairs)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int32)), pa.array(total[pair])], names=["pair", "n"])

    return links.select("pairs").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, a_path: str, b_path: str, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of documents (doc_id, text).

    A is the tokenizer file at `a_path` (`ranks_path` may name its vocabulary as ranks, which is faster for plain texts), B the piece
    model at `b_path`.  Links are pairs of an A and a B token that end together; a pair of ids counts as often as it is linked in the whole corpus.
    `n_best` are the links whose count is the highest of their B id, `count_sum` adds up the counts of the links.  The
    documents' links are stored once; the counts, one per possible pair of ids at most, go to all tasks.  Texts
    that are null or empty, or that a tokenizer changes, have zeros and an empty string.  A null doc_id stays null; repeated
    rows count and are returned each; no rows give none; extra columns are ignored.
    """
    import numpy as np

    stored = store(aligned(docs, a_path, b_path, ranks_path))
    spark = docs.sparkSession
    v = vocabularies(a_path, b_path, ranks_path)
    pairs, width = v.pairs, v.width
    counts = np.zeros(len(pairs), np.int64)
    found = pair_counts(stored, len(pairs)).toArrow()  # bounded by the vocabularies
    counts[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    most = np.zeros(width, np.int64)
    np.maximum.at(most, pairs % width, counts)
    shared = spark.sparkContext.broadcast((counts, (counts == most[pairs % width]) & (counts > 0)))

    def run(batches):
        counts, best = shared.value
        for b in small(batches):
            links = b.column(5)
            at = links.offsets.to_numpy()
            own = links.values.to_numpy()[at[0] : at[-1]]
            sums, tops = (np.concatenate([[0], np.cumsum(x[own])]).astype(np.int64) for x in (counts, best))
            at = at - at[0]
            columns = [*b.columns[:4], pa.array(np.diff(at).astype(np.int64)), pa.array(np.diff(tops[at])), pa.array(np.diff(sums[at])), b.column(4)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return stored.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def token_groups(docs: DataFrame, a_path: str, b_path: str, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, group, start, end, a_ids, b_ids, overlaps): the groups of documents (doc_id, text) with their byte ranges in a space and the text.

    `overlaps` lists the pairs of A and B tokens of a group that share bytes, by their places in the group.  Texts without tokens
    (see `align`) have no rows.
    """

    def run(batches):
        import numpy as np

        v = vocabularies(a_path, b_path, ranks_path)
        for rows in _rows(batches):
            for doc_id, a, b in zip(rows.column(0).to_pylist(), *tokens(v, rows.column(1).to_pylist())):
                ids_a, ids_b, end_a, end_b, side, order, new, _ = groups(v, [a], [b])
                if not len(order):
                    continue
                start_a, start_b = end_a - v.a_len[ids_a], end_b - v.b_len[ids_b]
                group = np.empty(len(order), np.int64)
                group[order] = np.cumsum(new) - 1
                of_a, of_b = group[: len(a)], group[len(a) :]
                n = int(group.max()) + 1
                cut_a, cut_b = (np.searchsorted(g, np.arange(n + 1)) for g in (of_a, of_b))
                i, j = overlaps(start_a, end_a, start_b, end_b)
                cut = np.searchsorted(of_a[i], np.arange(n + 1))
                i, j = i - cut_a[of_a[i]], j - cut_b[of_b[j]]
                out = [[doc_id] * n, list(range(n)), start_a[cut_a[:-1]].tolist(), end_a[cut_a[1:] - 1].tolist()]
                out += [[ids[s:e].tolist() for s, e in zip(cut.tolist(), cut[1:].tolist())] for ids, cut in ((a, cut_a), (b, cut_b))]
                out.append([[{"a": x, "b": y} for x, y in zip(i[s:e].tolist(), j[s:e].tolist())] for s, e in zip(cut.tolist(), cut[1:].tolist())])
                ints, pair = pa.list_(pa.int32()), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), ints, ints, pair]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "group", "start", "end", "a_ids", "b_ids", "overlaps"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, group long, start long, end long, a_ids array<int>, b_ids array<int>, overlaps array<struct<a:int,b:int>>")
