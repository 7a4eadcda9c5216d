"""Byte-level BPE encoding and decoding with offsets (operator 12)."""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from .common import free_name, small

# characters of a slice of a long text, and of the texts that are encoded at once
SLICE = 1 << 16


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself if it is printable in Latin-1, else the next one from U+0100 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256))
    return [chr(b) if b in printable else chr(256 + next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def build(ranks: dict[bytes, int], pattern: str):
    """A tokenizer of the `tokenizers` library that merges by rank inside the matches of `pattern`.

    Every way to cut a token into two tokens is a merge of its rank, and a match that is a token is taken whole, as rank
    tokenizers do.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_chars()
    shown = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        for cut in range(1, len(token)):
            if token[:cut] in ranks and token[cut:] in ranks:
                merges.append((shown[token[:cut]], shown[token[cut:]]))
    made = Tokenizer(models.BPE(vocab={shown[token]: rank for token, rank in ranks.items()}, merges=merges, ignore_merges=True))
    split = pre_tokenizers.Split(Regex(pattern), "isolated")
    made.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


@functools.cache
def encoder(path: str, pattern: str):
    return build(read_ranks(path), pattern)


@functools.cache
def token_bytes(path: str) -> dict[int, bytes]:
    """Bytes of every id: the byte table reversed over the characters of its token."""
    return {rank: token for token, rank in read_ranks(path).items()}


def slices(text: str, limit: int = SLICE) -> Iterator[tuple[int, str]]:
    """(start, part) of a text, cut only where white space follows something else.

    The patterns of these vocabularies begin a match there whatever comes before, so the parts' tokens are the text's.
    A run without such a place is one part, however long.
    """
    start, size = 0, len(text)
    while size - start > limit:
        end = start + limit
        while end < size and not (text[end] in " \n" and not text[end - 1].isspace()):
            end += 1
        yield start, text[start:end]
        start = end
    if start < size or not size:
        yield start, text[start:]


def lots(texts, limit: int = SLICE) -> Iterator[list[tuple[int, int, str]]]:
    """(row, start, part) of texts, about `limit` characters at a time."""
    lot, held = [], 0
    for row, text in enumerate(texts):
        for start, part in slices(text or "", limit):
            lot.append((row, start, part))
            held += len(part)
            if held >= limit or len(lot) >= 1024:
                yield lot
                lot, held = [], 0
    if lot:
        yield lot


def encoded(tokenizer, texts, offsets: bool = False):
    """(row, ids, starts, ends) of parts of the texts, in order; offsets are characters of the whole text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    run = tokenizer.encode_batch if offsets else tokenizer.encode_batch_fast
    for lot in lots(texts):
        for (row, start, _), e in zip(lot, run([part for _, _, part in lot], add_special_tokens=False)):
            spans = e.offsets if offsets else ()
            yield row, e.ids, [start + s for s, _ in spans], [start + t for _, t in spans]


def decoded(ids, table: dict[int, bytes]) -> bytes | None:
    """Bytes of ids, none if one of them is no token."""
    try:
        return b"".join(map(table.__getitem__, ids))
    except KeyError:
        return None


def token_texts(ids, table: dict[int, bytes]) -> list[str]:
    """The characters that each id completes; a character split over ids belongs to the last of them.

    Joined they are the decoded text; bytes that form no character become U+FFFD.
    """
    import codecs

    reader = codecs.getincrementaldecoder("utf-8")("replace")
    ids = list(ids)
    return [reader.decode(table[i], final=k == len(ids) - 1) for k, i in enumerate(ids)]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = True) -> DataFrame:
    """`df` with a column of token ids by the rank file at `path`, and with `offsets` the first and last character of each token.

    New columns are `ids`, `starts` and `ends` (with underscores before names that are taken).  Tokens that share a split character
    have equal offsets.  Null and empty texts have no ids; repeated rows are encoded as they come; no rows give none.
    """
    added = [free_name(df, n) for n in (("ids", "starts", "ends") if offsets else ("ids",))]
    at = df.columns.index(text)

    def run(batches):
        for b in small(batches):
            columns = [[[] for _ in range(b.num_rows)] for _ in added]
            for row, *found in encoded(encoder(path, pattern), b.column(at).to_pylist(), offsets):
                for column, values in zip(columns, found):
                    column[row] += values
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, pa.list_(pa.int32())) for c in columns)], names=[*b.schema.names, *added])

    return df.mapInArrow(run, StructType([*df.schema.fields, *(StructField(n, ArrayType(IntegerType())) for n in added)]))


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """`df` with the decoded `bytes` of the array `ids`, and the `text` they are (underscores before names that are taken).

    Bytes that form no character, as at the ends of a cut list, become U+FFFD in the text and stay in the bytes.  A null array, and one with
    a null or an id that is no token, gives nulls.
    """
    added = [free_name(df, "bytes"), free_name(df, "text")]
    at = df.columns.index(ids)

    def run(batches):
        for b in small(batches):
            data = [None if x is None else decoded(x, token_bytes(path)) for x in b.column(at).to_pylist()]
            texts = [None if x is None else x.decode("utf-8", "replace") for x in data]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(data, pa.binary()), pa.array(texts, pa.string())], names=[*b.schema.names, *added])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(added[0], BinaryType()), StructField(added[1], StringType())]))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of documents (doc_id, text): ids are hashed as little-endian unsigned 32-bit integers.

    Texts are encoded and decoded part by part, so a task holds one part's tokens.  Null texts are empty; a null doc_id stays
    null; repeated rows are repeated; extra columns are ignored.
    """

    def run(batches):
        import numpy as np

        for b in small(batches):
            n = [0] * b.num_rows
            ids_hash, text_hash = ([hashlib.sha256() for _ in n] for _ in range(2))
            for row, ids, _, _ in encoded(encoder(path, pattern), b.column(1).to_pylist()):
                n[row] += len(ids)
                ids_hash[row].update(np.array(ids, "<u4").tobytes())
                text_hash[row].update(decoded(ids, token_bytes(path)))
            digests = [pa.array([h.hexdigest() for h in hashes], pa.string()) for hashes in (ids_hash, text_hash)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *digests], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
