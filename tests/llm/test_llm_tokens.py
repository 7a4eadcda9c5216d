"""Byte-level BPE and the alignment of two tokenizers, against the libraries themselves and brute force."""

import hashlib
import random
import struct
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkkit.llm import align, byte_bpe

RANKS, JSON, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def texts_of(rng, n):
    bits = ["a", "A", "1", " ", "  ", "\n", "'s", "'", "é", "ß", "字", "́", "​", " ", "😀", "👩‍👧", "\x00", "\t", "'ll", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>",
            "\x85", "٣", "Ⅷ", "the ", "house", "ing", "\r\n", "\x1c", "　", "▁"]
    made = ["".join(rng.choice(bits[: rng.randint(3, len(bits))]) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return made + [None, "", " ", "\n", "▁", "a▁b", "x" * 70_000, "word " * 30_000, " " * 5_000 + "y", "字" * 3_000, "a\n" * 70_000]


def test_slices_are_whole_and_change_no_token(reference):
    rng = random.Random(0)
    for text in texts_of(rng, 300):
        parts = list(byte_bpe.slices(text or "", 7))
        assert "".join(p for _, p in parts) == (text or "") and all((text or "")[s:].startswith(p[:50]) for s, p in parts[:200])
        if len(text or "") < 1000:
            assert [i for _, p in parts for i in reference.encode_ordinary(p)] == reference.encode_ordinary(text or "")


def test_round_trip_equals_the_rank_library(spark, reference):
    texts = texts_of(random.Random(1), 1500)
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "no id", 0), (3, texts[3], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 int").repartition(4)
    got = sorted(map(tuple, byte_bpe.round_trip(docs, RANKS, PATTERN).collect()), key=repr)
    want = []
    for i, t, _ in rows:
        ids = reference.encode_ordinary(t or "")
        assert reference.decode_bytes(ids) == (t or "").encode()
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert byte_bpe.round_trip(docs.limit(0), RANKS, PATTERN).count() == 0


def test_offsets_and_decoding(spark, reference):
    texts = texts_of(random.Random(2), 200)
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, starts int")
    encoded = byte_bpe.encode(docs, RANKS, PATTERN)
    assert encoded.columns == ["text", "starts", "ids", "_starts", "ends"]
    for r in encoded.collect():
        text = r["text"] or ""
        assert r["ids"] == reference.encode_ordinary(text)
        at = 0
        cut = [0]
        for c in text:
            at += len(c.encode())
            cut.append(at)
        done = 0
        for i, s, e in zip(r["ids"][:400], r["_starts"], r["ends"]):
            size = len(reference.decode_single_token_bytes(i))
            # the characters that hold the token's bytes
            assert cut[s] <= done and done + size <= cut[e] and (e - s == 1 or cut[e - 1] < done + size)
            done += size
    back = byte_bpe.decode(encoded, RANKS)
    assert back.columns[-2:] == ["bytes", "_text"]
    assert back.filter(~F.coalesce("text", F.lit("")).eqNullSafe(F.col("_text"))).count() == 0


def test_split_characters(spark):
    table = byte_bpe.token_bytes(RANKS)
    ids = [i for _, x, _, _ in byte_bpe.encoded(byte_bpe.encoder(RANKS, PATTERN), ["a😀字"]) for i in x]
    texts = byte_bpe.token_texts(ids, table)
    assert "".join(texts) == "a😀字" and "" in texts
    assert "".join(byte_bpe.token_texts(ids[:-1], table)).endswith("�")
    rows = spark.createDataFrame([(ids[:2],), (None,), ([],), ([50256],), ([1, None],)], "ids array<int>")
    got = [tuple(r)[1:] for r in byte_bpe.decode(rows, RANKS).collect()]
    assert got[0][0] == b"".join(table[i] for i in ids[:2]) and got[0][1].endswith("�")
    assert got[1:] == [(None, None), (b"", ""), (None, None), (None, None)]


def brute_alignment(texts):
    a_tok, b_tok = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_tok.encode_special_tokens = True
    back = {c: b for b, c in enumerate(byte_bpe.byte_chars())}
    rows, counts = [], Counter()
    for t in texts:
        a = a_tok.encode(" " + (t or ""), add_special_tokens=False).ids
        b = b_tok.encode(t or "")
        a_bytes = [bytes(back[c] for c in a_tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(a_bytes) != (" " + t).encode() or b"".join(b_bytes) != (" " + t).encode():
            rows.append((0, 0, [], []))
            continue
        at_a, at_b, at = {}, {}, 0
        for k, x in enumerate(a_bytes):
            at += len(x)
            at_a[at] = k
        at = 0
        for k, x in enumerate(b_bytes):
            at += len(x)
            at_b[at] = k
        ends = sorted(at_a.keys() & at_b.keys())
        links = [(a[at_a[e]], b[at_b[e]]) for e in ends]
        counts.update(links)
        i = j = 0
        printed = []
        for e in ends:
            printed.append(",".join(map(str, a[i : at_a[e] + 1])) + "|" + ",".join(map(str, b[j : at_b[e] + 1])))
            i, j = at_a[e] + 1, at_b[e] + 1
        rows.append((len(a), len(b), links, printed))
    most = Counter()
    for (x, y), n in counts.items():
        most[y] = max(most[y], n)
    for n_a, n_b, links, printed in rows:
        digest = hashlib.sha256(";".join(printed).encode()).hexdigest() if printed else ""
        yield n_a, n_b, len(printed), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_alignment_against_brute_force(spark, ranks):
    texts = texts_of(random.Random(3), 500)
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "an id is missing", None), (5, texts[5], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string").repartition(5)
    got = sorted(map(tuple, align.align(docs, JSON, PIECES, ranks).collect()), key=repr)
    want = sorted(((i, *r) for (i, _, _), r in zip(rows, brute_alignment([t for _, t, _ in rows]))), key=repr)
    assert got == want
    assert align.align(docs.limit(0), JSON, PIECES).count() == 0


def test_groups_and_overlaps(spark):
    texts = ["unbelievable houses", "字😀 naïve", None, "", "a▁b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    v = align.vocabularies(JSON, PIECES)
    by = {}
    for r in align.token_groups(docs, JSON, PIECES).orderBy("doc_id", "group").collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == {0, 1}
    for doc_id, rows in by.items():
        data = (" " + texts[doc_id]).encode()
        assert rows[0]["start"] == 0 and rows[-1]["end"] == len(data) and all(x["end"] == y["start"] for x, y in zip(rows, rows[1:]))
        for r in rows:
            sides = [[], []]
            for table, ids, spans in ((v.a_bytes, r["a_ids"], sides[0]), (v.b_bytes, r["b_ids"], sides[1])):
                assert b"".join(table[i] for i in ids) == data[r["start"] : r["end"]]
                at = 0
                for i in ids:
                    spans.append((at, at + len(table[i])))
                    at += len(table[i])
            want = {(i, j) for i, (s, e) in enumerate(sides[0]) for j, (t, f) in enumerate(sides[1]) if s < f and t < e}
            assert {(o["a"], o["b"]) for o in r["overlaps"]} == want and len(r["overlaps"]) == len(want)


def test_pairs_follow_from_the_vocabularies():
    v = align.vocabularies(JSON, PIECES)
    rng = random.Random(4)
    assert len(v.pairs) < 400_000
    for _ in range(3000):
        a, b = rng.randrange(len(v.a_bytes)), rng.randrange(len(v.b_bytes))
        x, y = v.a_bytes[a], v.b_bytes[b]
        at = v.pairs.searchsorted(a * v.width + b)
        assert (at < len(v.pairs) and v.pairs[at] == a * v.width + b) == bool(x and y and (x.endswith(y) or y.endswith(x)))
