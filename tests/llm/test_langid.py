import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from strandwise.llm.langid import NONE, Params, document_languages, language_segments, named_language, segment, tokens, train

SMALL = dataclasses.replace(Params(), per_language=80, common=2)


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, train(docs, "doc_id", "text", "lang", Params())


def test_named_language(spark):
    df = spark.createDataFrame([("en_GB",), ("Dutch",), (" PT ",), ("dut",), ("pt-BR",), ("und",), ("xx",), (None,), ("",), ("mul",), ("ger",)], "l string")
    assert [r[0] for r in df.select(named_language(F.col("l"))).collect()] == ["en", "nl", "pt", "nl", "pt", None, None, None, None, None, "de"]


def test_tokens_and_sentence_begins():
    w, first = tokens("Ab C3. Déjà -- vu\nx")
    assert w == ["ab", "", "déjà", "vu", "x"] and first == [True, False, True, False, True]


def sentences(docs, code):
    rows = docs.where(named_language(F.col("lang")) == code).where("text is not null").orderBy(F.desc("doc_id")).limit(40).collect()
    return [s for r in rows for s in r["text"].split(". ") if len(s.split()) >= 14 and "\n" not in s]


def test_held_out_mixtures(fitted):
    """Sentences of other documents than those that train, put together: nearly every boundary and language is found."""
    docs, model = fitted
    other = docs.sparkSession.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rng = random.Random(3)
    pools = {c: sentences(other, c) for c in ("en", "de", "fr", "es", "it", "pt", "nl")}
    # labels are wrong now and then: keep what the model finds in most sentences of a label
    right = total = 0
    for _ in range(60):
        a, b = rng.sample(sorted(pools), 2)
        x, y = rng.sample(pools[a], 3), rng.sample(pools[b], 2)
        found = {s[3] for s in segment([". ".join(x) + ". " + ". ".join(y) + "."], model)[0] if s[2] >= 12}
        total += 2
        right += len(found & {a, b})
    assert right / total > 0.85


def test_single_languages_capitals_and_lost_accents(fitted):
    _, model = fitted
    texts = {"fr": "Nous avons mesuré la liaison du composé avec la protéine et trouvé une affinité faible dans le foie", "de": "Die Proben aus der Niere wurden sofort eingefroren und mit einem Test untersucht, was noch geprüft werden muss", "nl": "Er werd geen giftigheid waargenomen, maar doses boven de grens verlaagden het gewicht van de dieren"}
    for code, t in texts.items():
        for v in (t, t.upper(), t.replace("é", "e").replace("ü", "u")):
            assert [s[3] for s in segment([v], model)[0]] == [code], v


def test_rejection_of_tables_and_sequences(fitted):
    _, model = fitted
    table = "\n".join(f"P{i}Q{i} CHEMBL{i * 37} {i}.{i}" for i in range(40))
    assert {s[3] for s in segment([table], model)[0]} == {NONE}


def test_odd_rows(spark, fitted):
    _, model = fitted
    long = "the level of the compound did not follow the expression of the enzyme in the liver. " * 3000
    df = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "   ", 3), (4, long, 4), (4, long, 4), (5, "¿", 5)], "doc_id long, text string, segment_no int")
    seg = language_segments(df, "doc_id", "text", model)
    rows = seg.collect()
    assert sum(r["doc_id"] == 4 for r in rows) == 2 and all(r["n_words"] == 48_000 and r["lang_code"] == "en" for r in rows if r["doc_id"] == 4)
    assert {r["lang_code"] for r in rows if r["doc_id"] != 4} == {NONE}
    got = {r["doc_id"]: r["lang_code"] for r in document_languages(seg).collect()}
    assert got == {1: NONE, 2: NONE, 3: NONE, 4: "en", 5: NONE}


def test_empty_training_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = train(docs, "doc_id", "text", "lang", SMALL)
    assert [s[3] for s in segment(["some words here"], model)[0]] == [NONE]
    assert language_segments(docs, "doc_id", "text", model).count() == 0
