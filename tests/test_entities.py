"""Dictionary search inside the task that has the text, and capitalised runs."""

from sparkkit.operators import entities as ent

TEXTS = [(1, "Is the İstanbul of the KELVIN Kelvin, is the"), (2, "is then. Is the"), (2, "the is the"), (3, None), (4, ""), (5, "C++ is the_ is the"), (6, "zz is")]
PHRASES = [("is the", "PHRASE", "p"), ("the", "WORD", "w"), ("kelvin", "UNIT", None), ("C++", "LANG", "l"), ("is", "VERB", "v"), ("", "NONE", "n"), (None, "NONE", "n")]


def spans(df):
    return sorted(tuple(r) for r in df.collect())


def tables(spark):
    return spark.createDataFrame(TEXTS, "k int, t string"), spark.createDataFrame(PHRASES, "phrase string, type string, description string")


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_dictionary_goes_to_the_texts(spark, monkeypatch):
    texts, phrases = tables(spark)
    found = ent.gazetteer_entities(texts, "k", "t", phrases)
    assert shuffles(found) == 0
    got = spans(found.select("key", "start", "end", "type", "entity").distinct())
    assert (1, 30, 36, "UNIT", "Kelvin") in got and (5, 12, 18, "PHRASE", "is the") in got
    assert not [g for g in got if g[:2] == (2, 0) and g[3] == "PHRASE"] and not [g for g in got if g[:2] == (5, 4) and g[3] == "PHRASE"]
    # larger dictionaries and long phrases find the same
    for name, limit in (("ENTRIES", 2), ("LONGEST", 3)):
        with monkeypatch.context() as m:
            m.setattr(ent, name, limit)
            assert spans(ent.gazetteer_entities(texts, "k", "t", phrases).select("key", "start", "end", "type", "entity").distinct()) == got
    assert ent.gazetteer_entities(texts, "k", "t", phrases.limit(0)).count() == 0


def test_extraction_shuffles_what_is_found_only(spark):
    texts, phrases = tables(spark)
    assert shuffles(ent.extract_entities(texts, "k", "t", phrases)) == 1


def test_only_words_that_begin_a_phrase_leave_a_task():
    import pyarrow as pa

    batch = pa.record_batch({"key": pa.array([7]), "text": pa.array(["no " * 500 + "yes we can"])})
    out = [r for b in ent._wanted_batches(iter([batch]), {"yes": 6, "can": 0}, 1) for r in b.to_pylist()]
    assert out == [{"key": 7, "word": "yes", "start": 1500, "end": 1503, "ahead": "yes we "}, {"key": 7, "word": "can", "start": 1507, "end": 1510, "ahead": None}]


def test_capitalised_runs(spark):
    rows = [(1, "we met Jean-Luc O’Brien and Élan Ωmega, iPhone Ab\nCd; a_B x2Y"), (2, "mail John.Doe@x.org or In New York see Windows11"), (3, "WORD " * 20_000)]
    texts = spark.createDataFrame(rows, "k int, t string")
    phrases = spark.createDataFrame([("New York", "GPE", "Places"), ("élan", "ZZ", "")], "phrase string, type string, description string")
    got = spans(ent.extract_entities(texts, "k", "t", phrases).select("key", "start", "type", "entity"))
    assert [g for g in got if g[0] == 1] == [(1, 7, "NAME", "Jean-Luc O’Brien"), (1, 28, "NAME", "Élan Ωmega"), (1, 28, "ZZ", "Élan"), (1, 47, "NAME", "Ab"), (1, 50, "NAME", "Cd"), (1, 59, "CARDINAL", "2")]
    assert [g[2:] for g in got if g[0] == 2] == [("EMAIL", "John.Doe@x.org"), ("NAME", "In New York"), ("GPE", "New York"), ("NAME", "Windows11"), ("CARDINAL", "11")]
    assert [g[1:3] + (len(g[3]),) for g in got if g[0] == 3] == [(0, "NAME", 99_999)]
    # a word of the dictionary is no name besides
    alone = ent.extract_entities(spark.createDataFrame([(1, "so Élan it is")], "k int, t string"), "k", "t", phrases)
    assert spans(alone.select("type", "entity")) == [("ZZ", "Élan")]
