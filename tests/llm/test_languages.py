"""Language profiles: held-out accuracy, the algebra of the vectors, odd rows."""

import zlib
from collections import Counter

import numpy as np
from llm_tables import DOCUMENT, TABLES

from punctual.llm import languages
from punctual.llm.registry import QUERIES


def plain_profile(text):
    """The bundle of a text's n-grams, one by one."""
    out, letters = np.zeros(languages.DIMENSION, np.int64), languages.letters_of([text])[0].tolist()
    for gram, n in Counter(zip(letters, letters[1:], letters[2:], strict=False)).items():
        bound = np.ones(languages.DIMENSION, np.int64)
        for at, code in enumerate(gram):
            bound *= np.roll(languages.letter_vector(code).astype(np.int64), 2 - at)
        out += n * bound
    return out


TEXTS = ["Hello, hello world", "", "123 --", "ÀÉ  x", "日本 日本", "a", "Ab" * 3000]


def test_profiles_are_bundles_of_bound_letters():
    letters = languages.letters_of(TEXTS)
    assert [len(x) for x in letters[:4]] == [19, 0, 0, 6]
    found = languages.profiles(letters, np.arange(len(TEXTS)), len(TEXTS))
    assert (found == np.array([plain_profile(t) for t in TEXTS])).all()
    together = languages.profiles(letters, np.zeros(len(TEXTS), int), 1)
    assert (together[0] == found.sum(axis=0)).all()


def test_registered_query_equals_plain_profiles(spark, folder, given):
    rows = [r for r in given("documents") if len(r[1]) < 1500][:60]
    rows += [(900, None, "en", "s", 0), (901, "", None, "s", 0), (902, "12 34", "de", "s", 0), (903, "Hallo", None, "s", 0)]
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in rows}
    sums = {}
    for number, text, lang, *_ in rows:
        if lang is not None and not held[number]:
            sums[lang] = sums.get(lang, 0) + plain_profile(text or "")
    sums = {lang: s / np.linalg.norm(s) for lang, s in sums.items()}
    found = QUERIES["op13_languages"](spark, folder(documents=(rows, DOCUMENT))).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        own = plain_profile(texts[r.doc_id] or "")
        assert r.held_out == held[r.doc_id]
        if not own.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosine = {lang: own @ s / np.linalg.norm(own) for lang, s in sums.items()}
        best = max(cosine.values())
        assert abs(r.score - best) < 1e-9 and cosine[r.lang_pred] > best - 1e-9


def test_held_out_accuracy(spark):
    found = QUERIES["op13_languages"](spark, TABLES).join(spark.read.parquet(f"{TABLES}/documents.parquet"), "doc_id")
    held = found.where("held_out AND length(text) >= 20").selectExpr("avg(cast(lang = lang_pred AS int))").first()[0]
    assert held > 0.98


def test_nothing_learned(spark):
    none = spark.createDataFrame([(1, "text", None, "s", 0), (2, None, "en", "s", 0)], DOCUMENT)
    assert [(r.lang_pred, r.score) for r in languages.predicted(none).collect()] == [("und", 0.0)] * 2
    assert languages.predicted(spark.createDataFrame([], DOCUMENT)).count() == 0


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(i % 4, "Wort für Wort" if i % 2 else "word by word", "de" if i % 2 else "en", "s", 0) for i in range(24)]
    frame = spark.createDataFrame(rows, DOCUMENT).selectExpr("*", "'x' AS lang_pred", "7 AS score", "1 AS held_out")
    found = languages.predicted(frame)
    assert found.columns[:5] == [c.split()[0] for c in DOCUMENT.split(", ")]
    assert found.count() == 24
    learned = {r.lang for r in found.where("NOT held_out").collect()}
    assert all(r.lang_pred == r.lang for r in found.collect() if r.lang in learned)


def test_ties_go_to_the_least_name(spark):
    rows = [(i, "same text", "xy"[i % 2], "s", 0) for i in range(20)]
    assert {r.lang_pred for r in languages.predicted(spark.createDataFrame(rows, DOCUMENT)).collect()} <= {"x", "y"}
