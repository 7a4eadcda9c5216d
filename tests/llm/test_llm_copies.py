"""Operators on texts and vectors: fingerprints, near-duplicates, repeats, quality; the pipeline."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparkkit.llm import components, lattice, quality, simhash, suffix, syncmers


def union(n, pairs):
    root = list(range(n))
    find = lambda i: i if root[i] == i else find(root[i])
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def words_of(rng, n):
    return [rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 300)) for _ in range(n)]


def near_texts(rng, n):
    base = [words_of(rng, rng.randint(20, 300)) for _ in range(n)]
    out = []
    for w in base:
        out.append(" ".join(w))
        for _ in range(rng.randint(0, 4)):
            v = list(w)
            v[rng.randrange(len(v))] = "edited"
            out.append(" ".join(v))
    return out


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(1000, i) for i in range(400, 600)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = union(1001, edges)
    assert got == {i: want[i] for e in edges for i in e if any(a != b and i in (a, b) for a, b in edges)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_all_pairs(spark, monkeypatch):
    rng = random.Random(1)
    texts = near_texts(rng, 60) + [None, "", " \t", "one", "ONE", "one two", "É x y z w", "a b " * 20_000]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    data = [(i, t, i) for i, t in zip(ids, texts)] + [(None, texts[0], 1), (ids[3], texts[3], 2)]
    df = spark.createDataFrame(data, "doc_id long, text string, fp long")
    fps = [brute_fingerprint(d[1]) for d in data]
    root = union(len(data), [(i, j) for i in range(len(data)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    want = []
    for k, (d, fp) in enumerate(zip(data, fps)):
        group = [data[j][0] for j in range(len(data)) if root[j] == root[k] and data[j][0] is not None]
        want.append((d[0], f"{fp:016x}", min(group)))
    for chunk in (4096, 3):  # the second splits every bucket
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [4096, 3])  # the second splits every bucket
def test_one_of_each_group_against_all_pairs(spark, monkeypatch, chunk):
    import corpus_pipeline

    rng = random.Random(5)
    texts = near_texts(rng, 60) + [None, "", "one two", "ONE  two", "one three"]
    rng.shuffle(texts)
    fps = [brute_fingerprint(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    want = {i for i, root in enumerate(union(len(texts), pairs)) if root == i}
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = [r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, df, "").collect()]
    assert sorted(got) == sorted(want) and len(pairs) > 50
    assert corpus_pipeline.one_of_each_group(spark, df.limit(0), "").count() == 0


def test_rows_with_repeated_or_null_ids_are_judged_by_their_own_text(spark):
    import corpus_pipeline

    rng = random.Random(7)
    a, b, alone = (" ".join(words_of(rng, 400)) for _ in range(3))
    rows = [(1, a), (2, a + " more"), (2, alone), (None, b), (None, b + " more"), (None, a.upper()), (1, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, df, "").collect()}
    assert {(1, a), (2, alone)} <= got and len(got) == 3 and (got - {(1, a), (2, alone)}) <= {(None, b), (None, b + " more")}


def test_pivots_lose_no_link():
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, (30, 3)).astype(np.uint64)).sum(axis=1, dtype=np.uint64) for c in centre])
    fps = np.unique(np.concatenate([centre, near]))
    links = [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 3]
    assert simhash.linked(fps, 3).tolist() == union(len(fps), links)


def brute_repeats(docs, least):
    """docs: (key, text) in order; equal rows are one document."""
    seen, out = {}, {}
    for doc in docs:
        data = (doc[1] or "").encode()
        mark = bytearray(len(data))
        for i in range(len(data) - least + 1):
            s = data[i : i + least]
            if seen.setdefault(s, (doc, i)) != (doc, i):
                mark[i : i + least] = b"\1" * least
        kept = bytes(x for x, m in zip(data, mark) if not m)
        out[doc] = (len(data), sum(mark), sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark)), hashlib.sha256(kept).hexdigest())
    return out


def repeat_docs():
    rng = random.Random(3)
    passage = [" ".join(words_of(rng, 40)) for _ in range(5)]
    texts = []
    for _ in range(150):
        parts = [" ".join(words_of(rng, rng.randint(1, 60))) for _ in range(rng.randint(1, 3))] + rng.sample(passage, rng.randint(0, 3))
        rng.shuffle(parts)
        texts.append(" é ".join(parts))
    texts += [texts[0], texts[1][5:], "ab" * 500, "ba" * 300, "x" * 99, "x" * 100, "x" * 101, "", passage[0] * 3, "long " + passage[1] + "z" * 3_000]
    return list(enumerate(texts)) + [(500, None), (None, texts[2]), (7, texts[7])]


@pytest.mark.parametrize("hot", [50_000, 3])
def test_repeats_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT_STRINGS", hot)
    docs = repeat_docs()
    got = {(r["doc_id"], r["n_bytes"]): (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    order = sorted(set(docs), key=lambda d: (d[0] is None, d[0]))
    want = brute_repeats(order, 100)
    assert got == {(d[0], v[0]): v for d, v in want.items()}


def test_segments_of_long_texts_and_small_lots(spark, monkeypatch):
    rng = random.Random(4)
    text = " ".join(words_of(rng, 3_000))
    offsets = np.array([0, len(text), len(text) + 50, 2 * len(text) + 50])
    data = np.frombuffer((text + "y" * 50 + text).encode(), np.uint8)
    whole = suffix.text_runs(data, offsets, 100)
    monkeypatch.setattr(suffix, "SEGMENT", 700)
    cut = suffix.text_runs(data, offsets, 100)
    for found in (whole, cut):
        # every 100-byte string lies in exactly one run
        for t in (0, 2):
            starts = sorted((s, n) for x, s, n in zip(*(c.tolist() for c in found[:3])) if x == t)
            assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts]).tolist()[:-1]] and sum(n for _, n in starts) == len(text) - 99
    assert not (whole[0] == 1).any()


def test_interval_expansion_finds_all_equal_strings():
    rng = np.random.default_rng(5)
    for trial in range(40):
        parts = [bytes(rng.integers(97, 99 + trial % 3, rng.integers(1, 60)).astype(np.uint8)) for _ in range(rng.integers(1, 8))] * (1 + trial % 2)
        least, text = int(rng.integers(2, 12)), b"".join(p + b"\xff" for p in parts)
        want = {}
        for i in range(len(text) - least + 1):
            if b"\xff" not in text[i : i + least]:
                want.setdefault(text[i : i + least], []).append(i)
        got = {}
        for p, k in zip(*(x.tolist() for x in suffix.repeated(np.frombuffer(text, np.uint8), least))):
            got.setdefault(k, []).append(p)
        assert sorted(map(sorted, got.values())) == sorted(v for v in want.values() if len(v) > 1)


def test_dropping_repeats_keeps_columns_and_whole_characters(spark):
    passage = "éà" + "".join(chr(0x4E00 + i) for i in range(138))
    df = spark.createDataFrame([(1, passage, "s", 140, 0), (2, "a" + passage + "b", "s", 142, 1), (3, None, None, None, 2)], "doc_id long, text string, source string, n_chars long, key int")
    got = {r["doc_id"]: r for r in suffix.drop_repeats(df).collect()}
    assert got[1]["text"] == passage and got[2]["text"] == "ab" and got[2]["n_chars"] == 2 and got[3]["text"] is None
    assert suffix.drop_repeats(df).columns == df.columns and suffix.drop_repeats(df.limit(0)).count() == 0


def test_repeats_with_clashing_names(spark):
    passage = " ".join(f"word{i}" for i in range(40))
    names = ("__kept", "__spans", "__text", "__key", "__tie", "__of", "__gone", "kept", "spans", "own_key")
    rows = [(1, f"a {passage} b", *range(10)), (2, f"c {passage} d", *range(10, 20))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    got = {r["doc_id"]: r for r in suffix.drop_repeats(df).collect()}
    assert got[1]["text"] == rows[0][1] and passage not in got[2]["text"]
    assert all(tuple(got[r[0]])[2:] == r[2:] for r in rows)


def test_lattice_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 24))
    vectors = np.concatenate([centres, *(c + 0.05 * rng.standard_normal((12, 24)) for c in centres)]).astype(np.float32)
    data = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(vectors)]
    n = len(data)
    data += [(n + 1, data[3][1], 1), (n + 2, data[3][1], None), (n + 3, [0.0] * 24, 0), (n + 4, None, 0), (n + 5, [float("nan")] * 24, 0), (n + 6, [], 0),
             (n + 7, [None] + [1.0] * 23, 0), (n + 8, [2.0 * x for x in data[4][1]], 0), (n + 9, data[4][1][:8], 0), (n + 10, [float("inf")] * 24, 0), (3, data[3][1], 1)]
    links = []
    for i, (_, v, a) in enumerate(data):
        for j, (_, w, b) in enumerate(data[:i]):
            if a == b and a is not None and v and w and len(v) == len(w) and None not in v + w:
                x, y = np.array(v, float), np.array(w, float)
                with np.errstate(all="ignore"):
                    if np.isfinite(x + y).all() and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                        links.append((i, j))
    root = union(len(data), links)
    want = sorted((d[0], sum(i in e for e in links), min(data[j][0] for j in range(len(data)) if root[j] == root[i])) for i, d in enumerate(data))
    for chunk in (1024, 5):
        monkeypatch.setattr(lattice, "CHUNK", chunk)
        got = lattice.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<float>, label int"))
        assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()) == want
    assert got.filter("kept <> (vec_id = component_id)").count() == 0 and len(links) > 500
    assert lattice.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_lattice_points_are_the_nearest():
    x = np.random.default_rng(7).normal(size=(500, 8)) * 2
    p = lattice.nearest_e8(x)
    others = ((x[:, None] - p[:, None] - lattice.shortest()[None]) ** 2).sum(axis=2).min(axis=1)
    assert (((x - p) ** 2).sum(axis=1) <= others + 1e-9).all() and lattice.shortest().shape == (240, 8)


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(docs, quality.graded(labels).filter("doc_id % 4 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    held = quality.graded(labels).filter("doc_id % 4 = 0")
    got = quality.score(docs.join(held, "doc_id").select("doc_id", "text", "grade", F.lit(1).alias("KEPT")), model)
    stats = {r["grade"]: r for r in got.groupBy("grade").agg(F.avg(F.col("_kept").cast("int")).alias("kept"), F.avg("expected_grade").alias("mean")).collect()}
    assert stats[2]["kept"] > 0.97 and stats[0]["kept"] < 0.3 and stats[1]["kept"] < 0.25
    assert stats[0]["mean"] < stats[1]["mean"] < stats[2]["mean"]


def test_quality_without_labels_and_odd_texts(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "word " * 40_000, 3), (None, "!!! ***", 4), (1, None, 1)], "doc_id long, text string, p_best int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, quality.keep_good(df, none).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, 0), (None, 1, 1), (9, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.score(df, quality.train(df, quality.graded(labels))).count() == 5
    assert quality.keep_good(df.limit(0), labels).count() == 0


def brute_syncmers(text):
    """Positions of the closed syncmers, with Spark's hashes taken from a table of the parts."""
    h = xxhash.xxh64_intdigest
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    chain = lambda values: _chain(values)

    def _chain(values):
        seed = 42
        for v in values:
            seed = h((v & (1 << 64) - 1).to_bytes(8, "little"), seed)
        return signed(seed)

    words = []
    for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in text).split(" "):
        words += list(w) if len(w) > 16 else [w] * bool(w)
    words = [signed(h(w.encode(), 42)) for w in words]
    if len(words) < 5:
        return [(0, None)] * bool(words)
    g = [chain(words[i : i + 2]) for i in range(len(words) - 1)]
    return [(i, chain(words[i : i + 5])) for i in range(len(words) - 4) if min(g[i], g[i + 3]) <= min(g[i + 1 : i + 3])]


def test_anchors_against_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(words_of(rng, n)) for n in (0, 1, 4, 5, 6, 7, 60, 800)] + ["x" * 3_000, "a b " + "xyz" * 7 + " " + "y" * 16 + " c d " + "语" * 17, "é" * 90 + "\n\n" + "ß " * 40, "same " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for r in df.select("id", syncmers.anchors(F.col("text")).alias("a")).collect():
        want = brute_syncmers(texts[r["id"]])
        got = [(x["pos"], x["hash"]) for x in r["a"]]
        assert [p for p, _ in got] == [p for p, _ in want] and all(h in (None, x) for (_, x), (_, h) in zip(got, want))


def brute_likeness(a, b):
    first = [{}, {}]
    for seen, anchors in zip(first, (a, b)):
        for pos, h in anchors:
            seen.setdefault(h, pos)
    a, b = first
    if not a and not b:
        return 1.0
    width = max(syncmers.LEAST_BAND, max([*a.values(), *b.values()]) // syncmers.BAND)
    moved = [b[h] - p for h, p in a.items() if h in b]
    best = max([sum((o + shift) // width == (m + shift) // width for o in moved) for shift in (0, width // 2) for m in set(moved)], default=0)
    return best / (len(a) + len(b) - best)


def test_likeness_of_positions(spark):
    rng = random.Random(10)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    one, two, passage = fresh(10_000), fresh(10_000), fresh(200)
    runs = "".join(chr(0x4E00 + rng.randrange(5_000)) for _ in range(3_000))
    filler = fresh(300)
    pairs = [(one + " " + two, two + " " + one), (one + " " + passage, passage + " " + two), (one, one), (one, two), ("", ""), ("", "a"), ("a b", "a b"),
             (runs, "x" + runs), (runs, runs[:1500] + "x" + runs[1500:]), (one, fresh(20) + " " + one), (filler + " " + passage + " " + filler, passage + " " + filler),
             *[(" ".join(words_of(rng, 400)), " ".join(words_of(rng, 300))) for _ in range(5)], ("same " * 500, "same " * 300), (one, one.replace(" w1", " v1"))]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id long, a string, b string").repartition(4)
    tables = df.select("id", syncmers.table(F.col("a")).alias("a"), syncmers.table(F.col("b")).alias("b"))
    got = [r["n"] for r in tables.select("id", syncmers.likeness(F.col("a"), F.col("b")).alias("n")).orderBy("id").collect()]
    assert abs(got[0] - 1 / 3) < 0.01 and 0 < got[1] < 0.03 and got[2:7] == [1, 0, 1, 0, 1]
    assert got[7] > 0.99 and got[8] > 0.99 and got[9] > 0.99
    known = [i for i, p in enumerate(pairs) if all(len(t.split()) > 4 or not t or len(t) > 80 for t in p)]
    for i in known:
        want = brute_likeness(*[brute_syncmers(t) for t in pairs[i]])
        assert got[i] == pytest.approx(want), i


def test_fingerprints_of_edited_and_next_texts(spark):
    rng = random.Random(9)
    texts = near_texts(rng, 25) + ["", "one", "one two", "\t", "w " * 30_000]
    data = [(3 * i, t, "n") for i, t in enumerate(texts)] + [(2, None, "n"), (None, texts[0], "n")]
    df = spark.createDataFrame(data, "doc_id long, text string, n_chars string").repartition(4)
    got = {r["doc_id"]: r for r in syncmers.fingerprints(df).collect()}
    order = sorted(data, key=lambda d: (d[0] is None, -(d[0] or 0)))
    prints = {}
    for i, (doc_id, text, _) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        r = got[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"] and 0 <= r["near_edited"] <= 1
        hashes = sorted({h for _, h in brute_syncmers(text)}) if len(text.split()) > 4 else None
        if hashes and max(len(w) for w in text.split()) <= 16:
            assert r["fingerprint"] == "".join(f"{h & (1 << 64) - 1:016x}" for h in hashes[: syncmers.KEPT])
        edited = text[: len(text) - half] + after[:half]
        for name, other in (("near_edited", edited), ("near_next", after)):
            if all(len(brute_syncmers(t)) != 1 for t in (text, other)):
                assert r[name] == pytest.approx(brute_likeness(brute_syncmers(text), brute_syncmers(other)))
        if text == after:
            assert r["near_next"] == 1
    assert np.mean([r["near_edited"] for r in got.values()]) > 0.2
    alone = syncmers.fingerprints(df.filter("doc_id = 0")).first()
    assert alone["near_next"] == 1.0
    twice = syncmers.fingerprints(df.unionByName(df.filter("doc_id = 3")))
    assert twice.count() == len(data) + 1 and syncmers.fingerprints(df.limit(0)).count() == 0


def test_pipeline_runs_every_stage_on_what_is_left(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, corpus_pipeline.store(stage(spark, left, folder))
        assert left.columns == docs.columns, name
        assert left.join(before, "doc_id", "left_anti").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, left, folder)
    assert packed.select("doc_id").distinct().count() == left.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, folder).count() == packed.count()


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names and set(entry.oracle_sql()) <= set(names)
