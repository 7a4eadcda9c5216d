"""Operators on pages, mixes and packs: archives, URL filters, mixing, packing, licences."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkkit.llm import licences, mix, packing, url_filter, warc

BPE, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, source string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_warc_round_trip_with_copies_nulls_and_long_pages(spark):
    copy, long = "x" * 100, "é\r\n\r\nWARC/1.1\r\n" * 50_000
    data = [(1, "http://a/", copy), (2, None, copy), (3, "u\r\nX: y", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""),
            (7, "u", long), (8, "u", long), (1, "u", copy), (None, "u", copy), (9, "u", "y" * 99)]
    got = rows(warc.round_trip(spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)))
    want = []
    for page_id, _, html in data:
        payload = (html or "").encode()
        first = min((p for p, _, h in data if h == html and p is not None), default=None)
        revisit = len(payload) >= 100 and first != page_id
        want.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want, key=repr)


def test_warc_of_no_pages_and_several_archives(spark, tmp_path):
    assert rows(warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string"))) == []
    pages = spark.range(30).selectExpr("id page_id", "'u' url", "repeat(cast(id as string), 50) html").coalesce(1)
    archives = warc.write_archives(pages, f"file://{tmp_path}/a", roll_bytes=2_000)
    assert archives.count() > 1 and archives.groupBy().sum("records").first()[0] == 30
    members = warc.normalise(archives, f"file://{tmp_path}/b")
    for path, n in members.collect():
        path = path.removeprefix("file://")
        lines = [x.split() for x in open(path + ".idx")]
        data = open(path, "rb").read()
        # every record is a member that can be read alone
        assert len(lines) == n and sum(int(x[1]) for x in lines) == len(data)
        assert all(zlib.decompress(data[int(o) : int(o) + int(k)], 31).startswith(b"WARC/1.1") for o, k, _ in lines)
    assert warc.read_archives(warc.normalise(members, f"file://{tmp_path}/c"), per_read=7).count() == 30


def test_damaged_archives_raise():
    with pytest.raises(ValueError):
        list(warc.records([b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"]))


def brute_url(url, rules):
    host, path = url_filter.split_url(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def test_url_trie_against_all_rules(spark):
    rng = random.Random(2)
    labels, segments = ["a", "b", "com", "org", ""], ["", "x", "xy", "en", "1"]
    make_host = lambda: ".".join(rng.choices(labels, k=rng.randint(1, 3)))
    make_path = lambda: "".join("/" + s for s in rng.choices(segments, k=rng.randint(1, 3)))
    rules = [(make_host(), make_path(), rng.choice(["allow", "block"])) for _ in range(60)] + [("com", "", "block")]
    urls = [f"http://{make_host()}{rng.choice(['', make_path()])}{rng.choice(['', '?q=/x', '#f'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "://", "HTTP://A.COM", "x://y://com/x", "http://b.com/" + "x/" * 20_000, urls[0]]
    # columns of the result's names are kept as they are
    df = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, host long")
    got = {r["host"]: (r["_host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df, rules).collect()}
    assert got == {i: brute_url(u, rules) for i, u in enumerate(urls)}
    assert url_filter.filter_urls(df.limit(0), rules).count() == 0


def test_mix_reaches_targets(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(["w"] * rng.randint(1, 60)), f"s{i % 5}") for i in range(4000)]
    docs += [(None, None, None), (5000, "", "empty"), (5001, "a\tb\x0bc\u00a0d", None), (1, "w w", "s1"), (1, "w w", "s1")]
    df = spark.createDataFrame(docs, DOCS)
    planned = mix.plan_mix(df, mix.words("text"))
    got = planned.collect()
    assert len(got) == len(docs) and rows(planned) == rows(mix.plan_mix(df.repartition(5), mix.words("text")))
    sizes = {}
    for d in docs:
        sizes[d[2]] = sizes.get(d[2], 0) + len([w for w in (d[1] or "").replace("\u00a0", "_").split()])
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, total = {}, 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in target]
        level = (total - sum(target.values())) / sum(weights[s] for s in rest)
        over = [s for s in rest if level * weights[s] >= 2 * sizes[s]]
        if not over:
            break
        target.update({s: 2 * sizes[s] for s in over})
    target.update({s: level * weights[s] for s in rest})
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]]) and 0 <= r["copies"] <= 2
    for s in order[:5]:
        taken = sum(r["size"] * r["copies"] for r in got if r["source"] == s)
        assert taken == pytest.approx(target[s], rel=0.1)
    assert sorted(mix.mix(df).select("doc_id").toPandas().doc_id.fillna(-1)) == sorted(x for r in got for x in [-1 if r["doc_id"] is None else r["doc_id"]] * r["copies"])
    assert mix.plan_mix(df.limit(0), mix.words("text")).count() == 0


def test_tokens_equal_the_tokenizer():
    slow, rng = Tokenizer.from_file(BPE), random.Random(3)
    texts = ["", " ", "don't  stop\n\n x", "a<|endoftext|>b", "日本語 text", "x" * 30_000, " " * 5_000, "ﬁ ² Ⅷ", "\x1c\x85\u00a0 a\u2028b"]
    texts += ["".join(rng.choices("ab 1é'ſ\n\t.!\x00\x1f\u00a0\u02af‘’", k=200)) for _ in range(50)]
    for t in texts:
        assert packing.token_ids(t, BPE, RANKS).tolist() == [*slow.encode(t, add_special_tokens=False).ids, 2], t[:50]


def test_packing_is_whole_gapless_and_tight(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "of", "the", "x1"], k=rng.randint(0, 900))) for _ in range(300)]
    docs = [(i, t, "s") for i, t in enumerate(texts)] + [(1000, None, None), (1001, "w " * 30_000, "s"), (3, texts[3], "s"), (None, "a b", "s")]
    df = spark.createDataFrame(docs, DOCS).withColumnRenamed("source", "length")
    out = [r.asDict() for r in packing.pack(df, BPE, RANKS).collect()]
    want = []
    for doc_id, text, _ in docs:
        ids = packing.token_ids(text, BPE, None)
        cut = len(ids) % 1024 or 1024
        for i, (s, e) in enumerate(zip([0, *range(cut, len(ids), 1024)], range(cut, len(ids) + 1, 1024))):
            want.append((doc_id, i, s, e - s, zlib.crc32(ids[s:e].tobytes())))
    assert sorted((tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in out), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in sorted(out, key=lambda r: r["offset"]):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 1024
    gaps = []
    for x in sorted((w[3] for w in want), reverse=True):
        fit = min((g for g in gaps if g >= x), default=None)
        if fit is None:
            gaps.append(1024 - x)
        else:
            gaps.remove(fit)
            gaps.append(fit - x)
    assert len(bins) <= len(gaps) + 2
    assert packing.pack(df.limit(0), BPE, RANKS).count() == 0


def test_packing_plans_place_every_item_once():
    rng = random.Random(5)
    for _ in range(20):
        counts = {rng.randint(130, 1024): rng.randint(1, 400) for _ in range(rng.randint(1, 60))}
        starts, uses, firsts, bins = packing.plan_large(counts, 1024, rng.choice([3, 50, 5000]))
        held, rank = [0] * bins, 0
        for size in sorted(counts, reverse=True):
            for _ in range(counts[size]):
                k = max(i for i, s in enumerate(starts) if s <= rank) if len(starts) < 50 else int((starts <= rank).sum()) - 1
                held[firsts[k] + (rank - starts[k]) % uses[k]] += size
                rank += 1
        assert max(held) <= 1024 and min(held) > 0


def test_licences_are_found_and_inherited(spark):
    files = [(1, "a/LICENSE", "Released under the MIT License.\n"), (2, "a/b/x.py", "plain words\nmore"), (3, "a/b/LICENSE", None),
             (4, "a/b/y.py", "# Licensed under the Apache License,\n# Version 2.0.\ncode"), (5, "c/z", "the license"), (6, None, "Licensed under CC BY-NC 4.0."),
             (7, "LICENCE", "This work is licensed under CC BY 4.0."), (8, "a/b/x.py", "plain words\nmore"), (9, "d/w", ""),
             (10, "e/v", "word " * 50_000 + "\nlicensed under the GNU General Public License, version 3.\n" + "word\n" * 1000)]
    df = spark.createDataFrame(files, "id long, path string, text string")
    got = {r["id"]: (r["licence"], r["origin"], r["directory"]) for r in licences.scan(df).collect()}
    assert got == {1: ("MIT", "file", None), 2: ("MIT", "inherited", "a"), 3: ("MIT", "inherited", "a"), 4: ("Apache-2.0", "header", None), 5: ("CC-BY-4.0", "inherited", ""),
                   6: ("CC-BY-NC-4.0", "header", None), 7: ("CC-BY-4.0", "file", None), 8: ("MIT", "inherited", "a"), 9: ("CC-BY-4.0", "inherited", ""), 10: ("GPL-3.0", "header", None)}
    assert licences.scan(df.limit(0)).count() == 0


def _wrap(text, width, before=""):
    import textwrap

    return "\n".join(before + line for line in textwrap.wrap(text, width))


def test_full_texts_wrapped_headers_and_long_files(spark):
    mit, bsd3 = licences.TEMPLATES["MIT"][1], licences.TEMPLATES["BSD-3-Clause"][0]
    apache, gpl = licences.TEMPLATES["Apache-2.0"][2], licences.TEMPLATES["GPL-3.0"][2]
    prose = "The quick brown fox jumps over the lazy dog and the work goes on under the sun. "
    files = [(1, "m/LICENSE", "MIT License\n\nCopyright (c) 2020 A. Writer\n\n" + _wrap(mit, 78)), (2, "m/src/x.c", prose), (3, "b/COPYING", "Copyright 2021 Someone\n" + _wrap(bsd3, 70)),
             (4, "s/a.py", "#!/usr/bin/env python\n" + _wrap(apache, 60, "# ") + "\nimport os\n" + prose * 50), (5, "s/b.py", prose * 3 + gpl + " " + prose * 3),
             (6, "s/c.py", "# Released\n#\n# under the\n# MIT License.\n" + prose), (7, "s/d.py", prose * 20_000),
             (8, "s/e.py", (prose + "\n") * 50_000 + _wrap(mit, 40, " * ") + ("\n" + prose) * 50_000), (9, "s/f.py", "software license work version " * 20_000)]
    files += [(i, f"z/{i}", prose + str(i)) for i in range(10, 60)]
    df = spark.createDataFrame(files, "id long, path string, text string")
    got = {r["id"]: (r["licence"], r["origin"]) for r in licences.scan(df).collect()}
    want = {1: ("MIT", "file"), 2: ("MIT", "inherited"), 3: ("BSD-3-Clause", "file"), 4: ("Apache-2.0", "header"), 5: ("GPL-3.0", "header"), 6: ("MIT", "header"), 8: ("MIT", "header")}
    assert got == {i: want.get(i, (None, None)) for i, _, _ in files}


def test_common_words_weigh_little_at_every_table_size(spark):
    notice = "Distributed under the MIT License by the authors."
    found = []
    for n in (20, 400):
        texts = [("x", notice)] + [("y", f"the words by the authors under the number {i}") for i in range(n)]
        got = licences.scores(spark.createDataFrame(texts, "name string, text string"), {"MIT": ["Released under the MIT License."]}, 0.5).collect()
        found.append(got[0]["cosine"])
    # the weight of words in nearly all files does not grow with the table
    assert len(found) == 2 and abs(found[0] - found[1]) < 0.05


def test_licence_cosines_against_brute_force(spark):
    import math
    import re
    from collections import Counter

    rng = random.Random(6)
    templates = {"B": ["Released under the MIT License."], "A": ["licensed under the apache license, version 2.0. foo bar", "bar bar baz mit"]}
    vocabulary = ["licensed", "under", "the", "mit", "apache", "license", "version", "2.0", "released", "foo", "bar", "baz", "qux"]
    docs = []
    for i in range(300):
        lines = [" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ";"]) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(0, 12))]
        docs.append((rng.choice(["LICENSE", "a.c"]), None if i % 50 == 0 else "\n".join(lines)))
    docs += docs[:20]
    words = lambda t: re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", t.lower())
    df = Counter(t for _, d in docs if d is not None for t in set(words(d)))
    idf = lambda t: math.log((1 + len(docs)) / (1 + df[t])) + 1

    def cosine(x, y):
        x, y = ({t: m * idf(t) for t, m in Counter(z).items()} for z in (x, y))
        length = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
        return sum(v * y.get(t, 0) for t, v in x.items()) / length if length else 0.0

    want = Counter()
    for name, text in docs:
        if text is None:
            continue
        units = [u for u in map(words, re.split(r"[\r\n]+|(?<=[.!?;:])\s+", text)) if u]
        best = []
        for licence in sorted(templates):
            for template in map(words, templates[licence]):
                spans = [sum(units[s:e], []) for s in range(len(units)) for e in range(s + 1, len(units) + 1)]
                tried = [x for x in spans if len(x) <= 2 * len(template)] + ([words(text)] if name == "LICENSE" else [])
                best.append((max([cosine(x, template) for x in tried], default=0.0), licence))
        high = max(c for c, _ in best)
        if high >= 0.8:
            licence = min(a for c, a in best if c > high - 1e-12)
            want[(name, text, licence, round(high, 9))] = 1
    frame = spark.createDataFrame(docs, "name string, text string")
    keyed = frame.select("name", "text", licences.text_key(F.col("name"), F.col("text")).alias("key")).distinct()
    got = licences.scores(frame, templates).join(keyed, "key").collect()
    assert Counter((r["name"], r["text"], r["licence"], round(r["cosine"], 9)) for r in got) == want and len(want) > 20
    assert licences.scores(frame.limit(0), templates).count() == 0
