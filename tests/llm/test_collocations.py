"""Collocation mining against SQL and against counting every run."""

import re
from collections import Counter

import pytest
from llm_tables import DOCUMENT, TABLES

from punctual.llm import collocations
from punctual.llm.oracle import ORACLE
from punctual.llm.registry import QUERIES


def brute_force(rows, least, top=2000):
    counts, totals, out = Counter(), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, 5):
                    if i + m <= len(words):
                        counts[lang, tuple(words[i : i + m])] += 1
    for lang in totals:
        own = {p: a for (x, p), a in counts.items() if x == lang and a >= least}
        found = []
        for p, a in own.items():
            longer = [o for q, o in own.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if len(p) == 1 or any(100 * o >= 80 * a for o in longer):
                continue
            score, k = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


ODD = [
    ("a b c d. a b c d! a b c", "en"),
    ("A B C\tD  a b\na a a a a a", "en"),
    ("a b c d. a b c d! a b c", None),
    ("a b c d. a b c d! a b c", "und"),
    ("É é x É é x, É é", "fr"),
    (None, "en"),
    ("", "xx"),
    ("..,;", None),
    ("x" * 5000 + " y " * 400, "en"),
    ("new york city hall. " * 9 + "new york. " * 3 + "york new city", "de"),
]


def documents_of(rows):
    return [(i, text, lang, "s", 0) for i, (text, lang) in enumerate(rows)]


@pytest.mark.parametrize("least", [2, 3, 5])
def test_equals_counting_all_runs(spark, scratch, least):
    rows = ODD + ODD[:4] + [("new york city", "de")] * 5
    frame = spark.createDataFrame(documents_of(rows), DOCUMENT).selectExpr("*", "1 AS n", "'x' AS run", "2 AS rank")
    found = collocations.collocations(frame, scratch, least=least).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, least)


def test_top_and_ties(spark, scratch):
    rows = [(f"{x}1 {x}2", "en") for x in "dbca" for _ in range(3)]
    frame = spark.createDataFrame(documents_of(rows), DOCUMENT)
    found = collocations.collocations(frame, scratch, least=3, top=3).collect()
    assert sorted(map(tuple, found)) == brute_force(rows, 3, 3)
    assert [r.phrase for r in sorted(found, key=lambda r: r.rank)] == ["a1 a2", "b1 b2", "c1 c2"]


def test_no_rows(spark, scratch):
    assert collocations.collocations(spark.createDataFrame([], DOCUMENT), scratch).count() == 0


def test_long_texts_are_cut_at_pieces_only(monkeypatch, spark, scratch):
    monkeypatch.setattr(collocations, "TEXT", 64)
    text = "one two three four five. " * 40 + "no end " * 50
    assert "".join(collocations._blocks(text)) == text
    assert len(list(collocations._blocks(text))) > 3


def test_counts_of_all_runs_add_up_in_the_graph(spark, scratch):
    """Flow out of a node and piece ends give the counts of shorter runs."""
    frame = spark.createDataFrame(documents_of(ODD), DOCUMENT)
    graph = collocations.edges(frame, scratch, least=2)
    counts = collocations.counts_of(graph.where("words > 0"), scratch, least=2).collect()
    found = {(r.lang, r.run): r["count"] for r in counts}
    assert found["en", "a b c"] == 4
    assert found["en", "a a"] == 5 and found["en", "a a a a"] == 3
    assert found["de", "new york"] == 12
    held = {r.run: r.held for r in counts if r.lang == "de"}
    assert held["york city hall"] is None and held["new york city"] == 9 and held["new york"] is None


def test_registered_query_equals_sql(spark, sql_difference):
    found = QUERIES["op11_collocations"](spark, TABLES)
    assert sql_difference(found, TABLES, ORACLE["op11_collocations"]) is None


def test_registered_query_equals_sql_on_odd_rows(spark, folder, sql_difference):
    path = folder(documents=(documents_of(ODD * 31), DOCUMENT))
    assert sql_difference(QUERIES["op11_collocations"](spark, path), path, ORACLE["op11_collocations"]) is None
