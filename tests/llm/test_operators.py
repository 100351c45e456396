"""Each operator against brute force, on odd rows and on none."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.llm import block_search, chat, fingerprints, mixing, near_dups, packing, quality, shards, suffix_dedup, url_rules

random.seed(5)
WORDS = ["".join(random.choices("abcdeéß", k=random.randint(1, 9))) for _ in range(3000)]
text = lambda n: " ".join(random.choices(WORDS, k=n))
BASE, LONG = text(120), text(30_000)
ODD = [
    None,
    "",
    " \n ",
    "one two",
    BASE,
    BASE,
    BASE.replace(" ", "  ", 3).upper(),
    " ".join(BASE.split()[:118] + ["changed", "end"]),
    text(40) + BASE[:300] + text(40),
    "ab" * 400,
    "a" * 500,
    LONG,
    "x " + LONG[1000:90_000],
    *[text(60) for _ in range(5)],
]
REPEATED = [(7, "same id. one"), (7, "same id. two"), (None, "no id " + BASE), (7, "same id. one"), (None, None)]


def rows(df):
    return [r.asDict() for r in df.collect()]


def removed(texts):
    """(order, text) pairs -> n_bytes, n_removed, n_spans, digest of the rest, by order."""
    seen, out = set(), {}
    for order, t in sorted(texts):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            window = raw[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[order] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_equals_brute_force(documents, scratch):
    found = {r["doc_id"]: tuple(r.values())[1:] for r in rows(suffix_dedup.cut_bytes(documents(ODD), scratch))}
    assert found == removed(list(enumerate(ODD)))


def test_suffix_dedup_of_repeated_ids_and_no_rows(documents, scratch, spark):
    assert len(rows(suffix_dedup.cut_bytes(documents(REPEATED), scratch))) == len(REPEATED)
    kept = suffix_dedup.without_repeats(documents([BASE, "é" + BASE, "short"]), suffix_dedup.Scratch(spark, "t"))
    texts = {r["doc_id"]: r["text"] for r in rows(kept)}
    assert texts[0] == BASE and texts[2] == "short" and texts[1] == "é" and "score" in kept.columns
    assert rows(suffix_dedup.cut_bytes(documents([(0, "x")]).limit(0), suffix_dedup.Scratch(spark, "t"))) == []


def test_near_duplicates_equal_brute_force(documents, scratch):
    found = {r["doc_id"]: r["class_id"] for r in rows(near_dups.classes(documents(ODD), scratch))}

    def runs(t):
        w = re.findall(r"\w+", (t or "").lower())
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets, expected = [runs(t) for t in ODD], list(range(len(ODD)))
    for i, a in enumerate(sets):
        for j in range(i):
            same = (ODD[i] or "") == (ODD[j] or "")
            if same or (a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= 0.8):
                expected = [min(expected[i], expected[j]) if e in (expected[i], expected[j]) else e for e in expected]
    # long runs of two letters count as one word; texts without words only equal themselves
    assert found == dict(enumerate(expected))


def test_near_duplicates_of_repeated_ids_and_no_rows(documents, spark):
    result = near_dups.deduplicated(documents(REPEATED), near_dups.Scratch(spark, "t"))
    assert result.columns == documents(REPEATED).columns and result.count() == 4
    assert near_dups.deduplicated(documents([(0, "x")]).limit(0), near_dups.Scratch(spark, "t")).count() == 0


def test_probability_jaccard_is_estimated():
    random.seed(3)
    a, b = BASE, " ".join(w if random.random() > 0.04 else "new" for w in BASE.split())
    x, y = near_dups.shingles(a), near_dups.shingles(b)
    row = np.repeat([0, 1], [len(x[0]), len(y[0])])
    registers = near_dups.signatures(row, np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]]).astype(float), 2)
    assert abs((registers[0] == registers[1]).mean() - near_dups.similarity(x, y)) < 0.12


def test_packing_keeps_every_id(documents, spark):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    whole = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    texts = [*ODD[:13], "<|endoftext|> \u2003 …“é”\n\n", "日本語 1234 ½"]
    found = rows(packing.packed(documents(texts), packing.Scratch(spark, "t"), public.path("byte_bpe_50k.tiktoken")))
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for i, t in enumerate(texts):
        ids, at = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for p in sorted(pieces[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_shards_are_near_equal_and_gapless(documents, spark):
    many = [text(random.randint(1, 60)) for _ in range(300)] + [BASE] * 150 + [None, ""]
    out = rows(shards.sharded(shards.keyed(documents(many)), shards.Scratch(spark, "t")))
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in out:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["size"] == len((r["text"] or "").encode()) + 1 and r["score"] == "own"
    assert len(out) == len(many) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.06 * sum(sizes.values()) / 8
    assert rows(shards.sharded(shards.keyed(documents(many).limit(0)), shards.Scratch(spark, "t"))) == []


def test_fingerprints_add_up(documents, spark):
    one, two = "First line. And more!\nThird", "Third\nAnd more!\nFirst line."
    got = spark.createDataFrame([(one, two, one + "\nNew one.")], "a string, b string, c string").select(
        *[fingerprints.fingerprint(F.col(c)).alias(c) for c in "abc"],
        fingerprints.fingerprint(F.lit("New one.")).alias("d"),
    )
    r = got.select("*", fingerprints.combine(F.col("a"), F.col("d")).alias("e"), fingerprints.without(F.col("c"), F.col("d")).alias("f")).first()
    assert r.a == r.b == r.f and r.c == r.e and r.a != r.c


def test_edited_texts_take_the_next_document(documents):
    out = {r["doc_id"]: r for r in rows(fingerprints.edited_pairs(documents(ODD)))}
    order = sorted(out, reverse=True)
    for at, i in enumerate(order):
        own, following = ODD[i] or "", ODD[order[(at + 1) % len(order)]] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        assert out[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and out[i]["n_chars"] == len(own)
        assert 0 <= out[i]["near_next"] <= 1 and 0 <= out[i]["near_edited"] <= 1
    assert out[4]["fingerprint"] == out[5]["fingerprint"]
    assert len(rows(fingerprints.edited_pairs(documents(REPEATED)))) == len(REPEATED)
    assert rows(fingerprints.edited_pairs(documents(ODD).limit(0))) == []


def test_mixing_reaches_its_targets(documents, spark):
    many = documents([text(random.randint(5, 80)) for _ in range(200)] + [None, ""])
    out = rows(mixing.mixed(many, mixing.Scratch(spark, "t"), {"source": {"src0": 0.5}, "lang": 1.0}))
    mass = collections.Counter()
    for r in out:
        mass[r["source"]] += r["tokens"] * r["probability"]
    assert abs(mass["src0"] / sum(mass.values()) - 0.5) < 1e-3 and len(out) == 202
    assert {r["kept"] for r in out} == {True, False}
    assert rows(mixing.mixed(many.limit(0), mixing.Scratch(spark, "t"))) == []


def test_quality_tells_junk_from_prose(documents, spark):
    prose = [text(80) for _ in range(120)]
    junk = [(random.choice(WORDS) + "!! ") * 60 for _ in range(60)]
    docs = documents([*prose, *junk, None, ""])
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(180)] + [(3, None)], "doc_id long, quality int")
    out = rows(quality.judged(docs, labels))
    held = [r for r in out if r["held_out"] and r["doc_id"] < 180]
    assert len(out) == 182 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert np.mean([r["predicted"] == (r["doc_id"] < 120) for r in held]) > 0.95
    assert {r["score"] for r in rows(quality.judged(docs, labels.limit(0)))} == {0.5}
    assert rows(quality.judged(docs.limit(0), labels)) == []


def test_factors_score_in_linear_time():
    random_ = np.random.default_rng(1)
    m = quality.Model(0.3, random_.normal(size=9).astype("f4"), random_.normal(size=(9, quality.FACTORS)).astype("f4"))
    index, x = np.array([1, 4, 8]), np.array([0.5, 2.0, 1.0], "f4")
    pairs = sum(m.factors[a] @ m.factors[b] * x[i] * x[j] for i, a in enumerate(index) for j, b in enumerate(index) if i < j)
    expected = 1 / (1 + np.exp(-(m.bias + m.linear[index] @ x + pairs)))
    assert m.score(np.zeros(3, int), index, x, 1)[0] == pytest.approx(expected, rel=1e-4)


def test_search_equals_brute_force(spark):
    random_ = np.random.default_rng(2)
    vectors = [(i, [float(np.float32(v)) for v in random_.normal(size=6) // 0.25 / 4]) for i in range(300)]
    bad = [(400, None), (401, [1.0, None]), (402, [float("nan")]), (None, [1.0]), (404, [float("inf"), 1.0]), (20, vectors[20][1])]
    frame = spark.createDataFrame([*vectors, *bad], "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    own = block_search.quantised(frame)
    out = rows(block_search.top_k(own, own.where("vec_id % 20 = 0"), 20))
    whole = {i: np.floor(64 * np.array(v)).astype(int) for i, v in vectors}
    expected = []
    for q in range(0, 300, 20):
        best = sorted((-int(whole[q] @ w), i) for i, w in whole.items() if i != q)[:20]
        expected += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(tuple(r.values()) for r in out) == sorted(expected)
    assert rows(block_search.top_k(own.limit(0), own.limit(0))) == []


def test_chat_reads_back(spark):
    marks = "</s>[INST] ok [/INST]␛l<s>\\"
    turns = [(1, t, "user" if t % 2 else "assistant", text(random.randint(0, 200))) for t in range(40)]
    turns += [(2, 0, "system", "be\nkind"), (2, 1, "user", marks), (2, 2, "assistant", marks), (None, None, None, None)]
    turns += [(3, 0, "assistant", text(2000)), (3, 0, "assistant", "x"), (3, 0, "assistant", "x")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(1))
    formatted = chat.windows(frame)
    got = {r["conv_id"]: r for r in rows(chat.digest(formatted))}
    by = collections.defaultdict(list)
    for c, t, r, x in turns:
        by[c].append((t, r or "", x or ""))
    for c, own in by.items():
        own.sort(key=lambda x: (x[0] is None, x))
        whole = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest() and got[c]["n_turns"] == len(own)
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and got[c]["loss_chars"] == len(loss)
    assert formatted.where("conv_id = 1").count() > 3
    assert rows(chat.digest(chat.windows(frame.limit(0)))) == []


def test_urls_follow_listed_rules_then_mined_ones(spark):
    pages = [(i, f"https://{'bad' if i < 60 else 'good'}.x.org/{'ads' if i % 2 else 'news'}/{i}") for i in range(120)]
    extra = [(900, None), (901, "no scheme"), (902, "http://WWW.Example.com/en/x?q#z"), (903, "http://a.example.com/en/"), (904, "http://b.net/fr"), (905, "x://c.net/fr/")]
    frame = spark.createDataFrame([*pages, *extra, extra[0]], "page_id long, url string").withColumn("rule", F.lit(1))
    labels = spark.createDataFrame([(i, i < 60 and i % 2 == 1) for i in range(120)], "page_id long, bad boolean")
    mined = url_rules.mine(frame, labels, url_rules.Scratch(spark, "t"))
    out = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows(url_rules.judge(frame, mined))}
    assert [i for i in range(120) if out[i][3] == "block"] == [i for i in range(60) if i % 2]
    assert out[900] == out[901] == ("", "", None, "allow")
    assert out[902] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert out[903][2:] == ("example.com/en/", "block") and out[904][2:] == (None, "allow")
    assert out[905][2:] == ("net/fr/", "block")
    nothing = url_rules.mine(frame, labels.limit(0), url_rules.Scratch(spark, "t"))
    assert rows(nothing) == [] and len(rows(url_rules.judge(frame.limit(0), nothing))) == 0


def test_near_duplicates_find_a_copy_with_a_line_repeated(documents, spark):
    prose, line = text(300), text(10)
    texts = [f"{prose}\n{line}" + f"\n{line}" * n for n in (0, 100, 400)] + [text(300)]
    found = {r["doc_id"]: r["class_id"] for r in rows(near_dups.classes(documents(texts), near_dups.Scratch(spark, "t")))}
    assert found == {0: 0, 1: 0, 2: 0, 3: 3}


def test_mixing_is_not_set_by_one_stray_row(documents, spark):
    many = documents([text(random.randint(200, 400)) for _ in range(400)]).drop("score", "part")
    stray = spark.createDataFrame([(900, text(20), "xx", "stray", 0)], many.schema)

    def masses(docs, n):
        own = rows(mixing.mixed(docs, mixing.Scratch(spark, f"t{n}")))
        assert all(0 < r["probability"] <= 1 for r in own)
        assert all(r["kept"] for r in own if r["source"] == "stray")
        total = collections.Counter()
        for r in own:
            total[r["source"]] += r["tokens"] * r["probability"]
        return total, sum(r["tokens"] for r in own)

    (without, n_without), (added, n_added) = masses(many, 0), masses(many.unionByName(stray), 1)
    # neither the kept share nor the mix of the others turns on the row
    assert abs(sum(added.values()) / n_added - sum(without.values()) / n_without) < 0.02
    for source in without:
        assert abs(added[source] / sum(added.values()) - without[source] / sum(without.values())) < 0.02


def test_packing_takes_the_ids_of_the_default_tokenizer(spark, tmp_path):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    from punctual.llm import registry

    whole = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = ["plain text", "a<|endoftext|> b", "x" + " " * 1_000_000 + "y", "\n" * 150_000 + "<|endoftext|>", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    pieces = collections.defaultdict(list)
    for r in rows(registry.op6_packing(spark, str(tmp_path))):
        pieces[r["doc_id"]].append(r)
    for i, t in enumerate(texts):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert sum(p["length"] for p in pieces[i]) == len(ids)
        for p in pieces[i]:
            assert p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())


def test_quality_learns_one_row_of_an_id(documents, spark):
    prose = [text(80) for _ in range(60)]
    junk = [(random.choice(WORDS) + "!! ") * 60 for _ in range(60)]
    repeated = next(i for i in range(60, 120) if zlib.crc32(str(i).encode()) % 5)
    docs = documents([*enumerate([*prose, *junk]), *[(repeated, f"{junk[0]} {n}") for n in range(300)]])
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    model = quality.train(docs, labels, sample=200)
    out = rows(quality.scored(docs, model))
    assert np.mean([r["score"] >= quality.THRESHOLD for r in out if r["doc_id"] < 60]) > 0.95
    assert np.mean([r["score"] < quality.THRESHOLD for r in out if r["doc_id"] >= 60]) > 0.95
