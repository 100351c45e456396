"""Token alignment against token-by-token loops, and minimal perfect hashes."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_tables import DOCUMENT

from punctual.llm import alignment, perfect_hash
from punctual.llm.registry import ALIGNED, QUERIES

PATHS = [public_tokenizers.path(name) for name in ALIGNED]

ODD = [
    "Hello world",
    "Hello world",
    None,
    "",
    " ",
    "\n\n  \t x",
    "a ▁ b",
    "<|endoftext|> and <s> </s> <0x41>",
    "日本語 🙂 é é \x00 ​",
    "x" * 3000,
    " " * 700 + "y",
    "Zusammenhängend unter-\r\nbrochen 12345 67",
]


def token_bytes():
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_file(PATHS[0])
    tokenizer.encode_special_tokens = True
    back = tokenizers.decoders.ByteLevel()
    return tokenizer, back


def brute_force(texts):
    """Rows as the contract has them, from one (end, id) walk for each document."""
    import sentencepiece

    tokenizer, _ = token_bytes()
    pieces = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    tables = alignment.Vocabularies(*PATHS)
    documents, holders, best = [], Counter(), defaultdict(int)
    for text in texts:
        raw = f" {text}".encode() if text else b""
        a = tokenizer.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        if b"".join(tables.a[i] for i in a) != raw or b"".join(tables.b[i] for i in b) != raw:
            a, b = [], []
        groups, links, i, j, end_a, end_b, own = [], [], 0, 0, 0, 0, ([], [])
        while i < len(a) or j < len(b):
            # the token whose end is behind goes on
            if end_a <= end_b and i < len(a):
                start, end_a = end_a, end_a + len(tables.a[a[i]])
                own[0].append(a[i])
                i += 1
            else:
                start, end_b = end_b, end_b + len(tables.b[b[j]])
                own[1].append(b[j])
                j += 1
            if end_a == end_b:
                groups.append(own)
                own = ([], [])
        places = lambda ids, table: np.cumsum([0, *(len(table[x]) for x in ids)])
        at_a, at_b = places(a, tables.a), places(b, tables.b)
        for x, y in ((x, y) for x in range(len(a)) for y in range(len(b))) if len(a) * len(b) < 1e6 else ():
            if at_a[x] < at_b[y + 1] and at_b[y] < at_a[x + 1]:
                links.append((a[x], b[y]))
        documents.append((a, b, groups, links))
        holders.update(set(links))
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    out = []
    for number, (a, b, groups, links) in enumerate(documents):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        sums = sum(holders[x] == best[x[0]] for x in links), sum(holders[x] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((number, len(a), len(b), len(groups), len(links), *sums, digest))
    return out


def rows_of(texts):
    return [(i, text, None, "s", 0) for i, text in enumerate(texts)]


def test_token_bytes():
    tables = alignment.Vocabularies(*PATHS)
    assert tables.a[220] == b" " and tables.a[198] == b"\n"
    assert tables.b[13] == b"\n" and tables.b[264] == b" a"
    assert {b for b in tables.a if len(b) == 1} == {bytes([b]) for b in range(256)}


def test_registered_query_equals_loops(spark, folder, given):
    texts = ODD + [row[1] for row in given("documents") if len(row[1]) < 1500][:80]
    path = folder(documents=(rows_of(texts), DOCUMENT))
    found = QUERIES["op12_alignment"](spark, path)
    assert found.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert sorted(map(tuple, found.collect())) == brute_force(texts)


def test_several_slices_and_levels(monkeypatch, spark, documents, scratch):
    texts = ODD + ["one two three", "four five six", "seven eight nine"] * 3
    frame = documents(texts).selectExpr("*", "1 AS row", "'x' AS a", "2 AS n_a").repartition(7)
    monkeypatch.setattr(alignment, "HELD", 60)
    monkeypatch.setattr(alignment, "FAN", 2)
    monkeypatch.setattr(alignment, "GATHERED", 20)
    found = alignment.aligned(frame, scratch, *PATHS).collect()
    assert sorted(map(tuple, found)) == brute_force(texts)


def test_no_rows(spark, scratch):
    assert alignment.aligned(spark.createDataFrame([], DOCUMENT), scratch, *PATHS).count() == 0


def test_texts_that_do_not_come_back_have_no_tokens(spark, documents, scratch):
    found = alignment.aligned(documents(["a ▁ b", None, "fine"]), scratch, *PATHS).collect()
    by_id = {r.doc_id: tuple(r)[1:] for r in found}
    assert by_id[0] == by_id[1] == (0, 0, 0, 0, 0, 0, "")
    assert by_id[2][0] > 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 62, n).astype(np.uint64))
    bucket = perfect_hash.build(keys)
    assert sorted(bucket.keys) == sorted(keys)
    other = perfect_hash.build(np.array([5, 6, 7], np.uint64))
    index = perfect_hash.Index([other, bucket])
    numbers = index.numbers(keys, np.ones(len(keys), int))
    assert sorted(numbers) == list(range(3, 3 + len(keys)))
    assert (index.verified(keys, numbers) == numbers).all()
    strange = np.setdiff1d(np.arange(100, 200, dtype=np.uint64), keys)
    found = index.numbers(strange, np.ones(len(strange), int))
    assert (index.verified(strange, found) == -1).all()
