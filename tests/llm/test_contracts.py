"""Registered queries against SQL, brute force and planted cases."""

import hashlib
import itertools
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow.dataset
import pytest
from llm_tables import DOCUMENT, TABLES
from pyspark.sql import functions as F

from punctual.llm import mixing, near_dups, packing, quality, shards, suffix_dedup, url_rules
from punctual.llm.oracle import ORACLE
from punctual.llm.registry import QUERIES

PAGE, LABEL = "page_id long, url string, html string", "doc_id long, quality int, toxic int"


def test_search_equals_sql(spark, sql_difference):
    found = QUERIES["op4_block_search"](spark, TABLES)
    assert sql_difference(found, TABLES, ORACLE["op4_block_search"]) is None


def test_search_with_ties_and_odd_vectors_equals_sql(spark, folder, sql_difference):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), 1.0, -0.5]) for i in range(90)]
    rows += [(100, None), (101, [nan, 1.0, 1.0]), (102, [inf, 0.0, 0.0]), (103, [None, 1.0, 0.0]), (120, [0.0, 0.0, 0.0])]
    path = folder(embeddings=(rows, "vec_id long, embedding array<float>"))
    assert sql_difference(QUERIES["op4_block_search"](spark, path), path, ORACLE["op4_block_search"]) is None


# near-duplicates


def test_classes_of_many_variants_equal_all_pairs(spark, folder):
    pick = random.Random(3)
    texts = []
    for base in range(3):
        words = [f"w{base}x{i}" for i in range(260)]
        for change in range(0, 50):
            own = list(words)
            for at in pick.sample(range(260), change // 6):
                own[at] = f"other{pick.random()}"
            texts.append(" ".join(own))
    texts += [texts[0], None, "", " ".join(f"b{i % 70}" for i in range(700))]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    found = {r.doc_id: r.class_id for r in QUERIES["op5_near_duplicates"](spark, folder(documents=(rows, DOCUMENT))).collect()}
    runs = [near_dups.shingles(t or "") for t in texts]
    class_of = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        same = (texts[i] or "") == (texts[j] or "")
        if class_of[i] != class_of[j] and (same or near_dups.similarity(runs[i], runs[j]) >= 0.8):
            low, high = sorted((class_of[i], class_of[j]))
            class_of = [low if c == high else c for c in class_of]
    assert found == dict(enumerate(class_of))
    assert 4 < len(set(class_of)) < len(texts)


def test_counters_never_hide_shared_runs():
    pick = np.random.default_rng(4)
    for n in (3, 400, 50_000):
        own = np.unique(pick.integers(0, 2**63, n).astype(np.uint64))
        other = np.unique(np.append(own[: n // 2], pick.integers(0, 2**63, n // 3).astype(np.uint64)))
        counts = near_dups.counters(own), near_dups.counters(other)
        full = any((c == 255).any() for c in counts)
        assert full or np.minimum(*counts).sum(dtype=int) >= len(np.intersect1d(own, other))


# chat


def test_chat_equals_sql(spark, sql_difference):
    assert sql_difference(QUERIES["op9_chat"](spark, TABLES), TABLES, ORACLE["op9_chat"]) is None


def test_chat_of_odd_turns_equals_sql(spark, folder, sql_difference):
    long = "w\u00e9 \u00a0x\x0by\t " * 30
    rows = [(1, i, "assistant" if i % 3 else "user", long * (i % 5)) for i in range(40)]
    rows += [(2, i, ("system", "user", "assistant")[i % 3], f"turn {i} " * (i * 7 % 90)) for i in range(50)]
    rows += [(3, i, "user", "no target") for i in range(3)] + [(4, 0, None, None), (4, None, "assistant", "last")]
    rows += [(5, 1, "assistant", "twice")] * 3 + [(None, 0, "a\n<s>", "\u241bn</s>\u241b[INST]"), (None, 1, "assistant", "")]
    rows += [(6, 0, "system", "rules " * 900), (6, 1, "assistant", "<s>" * 300), (6, 2, "assistant", "b")]
    path = folder(conversations=(rows, "conv_id long, turn long, role string, text string"))
    assert sql_difference(QUERIES["op9_chat"](spark, path), path, ORACLE["op9_chat"]) is None


# mixing


def raked(cells, powers):
    """Weight and probability of each cell of token counts, one step at a time."""
    total = sum(cells.values())
    share = {c: n / total for c, n in cells.items() if n}
    weights = dict.fromkeys(share, 1.0)
    targets = []
    for i, power in enumerate(powers):
        own = Counter()
        for c, p in share.items():
            own[c[i]] += p
        scale = sum(p**power for p in own.values())
        targets.append({v: p**power / scale for v, p in own.items()})
    for _ in range(200):
        for i, target in enumerate(targets):
            reached = Counter()
            for c, p in share.items():
                reached[c[i]] += p * weights[c]
            weights = {c: w * target[c[i]] / reached[c[i]] for c, w in weights.items()}
    steps = defaultdict(list)
    for c, w in weights.items():
        steps[math.floor(math.log2(w) * 64)].append(c)
    mass = 0.0
    for step in sorted(steps, reverse=True):
        mass += sum(share[c] * weights[c] for c in steps[step])
        if mass > 0.01:
            top = max(weights[c] for c in steps[step])
            break
    return {c: (w, min(1.0, w / top)) for c, w in weights.items()}


def test_mixing_equals_raking_one_step_at_a_time(spark, folder, given):
    rows = given("documents") + [(7000 + i, t, None, "src1", 0) for i, t in enumerate([None, "", "a b", "a b", "x@y " * 700])]
    found = QUERIES["op2_mixing"](spark, folder(documents=(rows, DOCUMENT))).collect()
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(r)
    cells, of = Counter(), {}
    for doc, text, lang, source, *_ in rows:
        text = text or ""
        tokens = text.count(" ") + 1 if text else 0
        marks = (("icense", "licensed"), ("@", "contact"), ("|", "listing"))
        topic = next((name for mark, name in marks if mark in text), "long" if tokens >= 500 else "short")
        of[doc] = (source, lang, topic), tokens
        cells[source, lang, topic] += tokens
    weights = raked(cells, (0.8, 0.8, 0.8))
    assert len(found) == len(rows) == len(of)
    for r in found:
        cell, tokens = of[r.doc_id]
        assert ((r.source, r.lang, r.topic), r.tokens) == (cell, tokens)
        weight, probability = weights.get(cell, (1.0, 1.0))
        assert (r.weight, r.probability) == pytest.approx((weight, probability), rel=2e-3)
        # the hash that decides, by the definition of `chance`
        own = hashlib.md5((texts[r.doc_id][0][1] or "").encode()).hexdigest()
        chance = int(hashlib.md5(f"mix-1:{r.doc_id}:{own}".encode()).hexdigest()[:13], 16) / 2**52
        if abs(chance - probability) > 2e-3:
            assert r.kept == (chance < probability)
    kept = sum(r.kept for r in found)
    assert abs(kept - sum(r.probability for r in found)) < 4 * len(found) ** 0.5


def test_contradicting_marginals_end_and_tell(spark, scratch):
    rows = [("a", "x", "t", 50), ("a", "y", "t", 30), ("b", "y", "t", 15), ("stray", "zz", "t", 5)]
    frame = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    with pytest.warns(UserWarning, match="off their targets"):
        out = mixing.rake(frame, scratch, {"source": {"stray": 0.2}, "lang": 1.0, "topic": 1.0}).collect()
    assert len(out) == 4 and all(0 < r.probability <= 1 for r in out)
    zero = {r.source_key: r.probability for r in mixing.rake(frame, mixing.Scratch(spark, "zero"), {"source": {"b": 0.0}}).collect()}
    assert zero["b"] == 0 and zero["a"] > 0
    with pytest.raises(ValueError, match="source"):
        mixing.rake(frame, mixing.Scratch(spark, "none"), {"source": {"elsewhere": 1.0}})


# shards


def test_shards_hold_equal_texts_whole(spark, folder, given):
    rows = given("documents")
    copies = [(5000 + i, text, "en", "s", 0) for i, text in enumerate(["copied text " * 40] * 9 + [None, "", None])]
    path = folder(documents=(rows + copies, DOCUMENT))
    found = QUERIES["op7_shards"](spark, path).collect()
    texts = {r[0]: (r[1] or "").encode() for r in rows + copies}
    assert sorted(r.doc_id for r in found) == sorted(texts)
    sizes, places, homes = Counter(), defaultdict(list), defaultdict(set)
    for r in found:
        text = texts[r.doc_id]
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < 8
        sizes[r.shard] += r.size
        places[r.shard].append(r.slot)
        homes[text].add(r.shard)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(len(h) == 1 for h in homes.values())
    group = max(n * (len(t) + 1) for t, n in Counter(texts.values()).items())
    mean = sum(sizes.values()) / 8
    assert all(abs(sizes[s] - mean) <= group for s in range(8))


def test_only_a_group_larger_than_a_shard_is_split(spark, documents, scratch):
    texts = ["hot " * 30] * 400 + [f"text number {i}" for i in range(400)]
    found = shards.sharded(shards.keyed(documents(texts)), scratch).collect()
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    assert len({r.shard for r in found if r.text.startswith("hot")}) > 1
    mean = sum(sizes.values()) / 8
    assert all(abs(sizes[s] - mean) < 0.1 * mean for s in range(8))


# URL rules

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def listed(url):
    """Host, path and rule by the contract, one URL at a time."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def planted(n):
    """n pages of a bad host among good ones of 20 hosts, and odd URLs."""
    bad = [(i, f"https://www{i % 3}.spam-host.org/p/{i}/x{i % 7}") for i in range(n)]
    good = [(10_000 + i, f"https://h{i % 20}.fine.org/p/{i}/y{i % 7}") for i in range(6 * n)]
    odd = [None, "nothing", "http://A.Example.com/en/x?y#z", "x://b.net/fr/?q", "http://www.example.com/en/", "http://c.com", "://", "http://spam.org/host"]
    return bad, good, [(90_000 + i, u) for i, u in enumerate(odd)]


@pytest.mark.parametrize("n", [40, 1500])
def test_a_planted_bad_host_is_blocked_at_any_size(spark, folder, n):
    bad, good, odd = planted(n)
    new = [(80_001, "https://www1.spam-host.org/p/next"), (80_002, "https://h3.fine.org/p/next")]
    labels = [(i, 0, 0) for i, _ in bad] + [(i, 1, 0) for i, _ in good]
    pages = bad + good + odd + new
    path = folder(pages=([(i, u, "") for i, u in pages], PAGE), labels=(labels, LABEL))
    found = {r.page_id: r for r in QUERIES["op10_url_rules"](spark, path).collect()}
    assert len(found) == len(pages)
    for number, url in pages:
        host, start, rule, verdict = listed(url)
        method = "block" if url and "spam-host.org" in url else "allow"
        got = found[number]
        assert (got.host, got.path, got.rule, got.verdict) == (host, start, rule, verdict or method)


def test_labels_that_do_not_follow_urls_block_nothing(spark, folder, given):
    path = folder(pages=(given("pages"), PAGE), labels=(given("labels"), LABEL))
    for r in QUERIES["op10_url_rules"](spark, path).collect():
        if r.rule is None:
            assert r.verdict == "allow"


def test_rules_of_common_words_on_long_urls_are_found(spark, scratch):
    """All combinations of words one by one, also of those beyond the rarest of their page."""
    draw, bad = random.Random(5), {"wa", "wb", "wc"}
    words = [f"w{chr(97 + i)}" for i in range(13)]
    rows = []
    for i in range(500):
        # the words of bad pages are the commonest, each also on good pages
        held = [w for at, w in enumerate(words) if draw.random() < (0.85 if at < 3 else 0.7)]
        sure = draw.random() < (0.9 if bad <= set(held) and "wk" in held else 0.1)
        rows.append((i, sure, f"http://h{i}x.org/" + "/".join(held)))
    new = [(1000 + i, None, "http://h.org/" + "/".join(draw.sample(words, 6))) for i in range(60)]
    pages = spark.createDataFrame([(i, u) for i, _, u in rows + new], "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, b, _ in rows], "page_id long, bad boolean")
    rules = url_rules.mine(pages, labels, scratch)
    got = {r.page_id: r.confidence for r in url_rules.judge(pages, rules, []).collect()}

    held = {i: set(u.split("/")[3:]) for i, _, u in rows + new}
    assert sum(len(held[i]) > url_rules.ITEMS for i, *_ in rows) > 50
    rate = sum(b for _, b, _ in rows) / len(rows)
    best = dict.fromkeys(held)
    for k in range(1, len(words) + 1):
        for some in map(set, itertools.combinations(words, k)):
            of = [b for i, b, _ in rows if some <= held[i]]
            sure = sum(of) / len(of) if len(of) >= 20 else 0
            if sure >= max(0.6, rate + 4 * (rate * (1 - rate) / max(1, len(of))) ** 0.5):
                for i in held:
                    if some <= held[i]:
                        best[i] = max(best[i] or 0, sure)
    assert any(best.values()) and not all(best.values())
    assert {i: c and round(c, 9) for i, c in got.items()} == {i: c and round(c, 9) for i, c in best.items()}


def test_variants_of_a_long_url_end_in_time(spark, scratch):
    """Pages with most of the same 25 words: one variant is bad, the others by chance."""
    draw = random.Random(7)
    words = [f"w{chr(97 + i)}" for i in range(25)]
    rows = []
    for i in range(600):
        held = [w for w in words if draw.random() < 0.98]
        rows.append((i, "wd" not in held or draw.random() < 0.2, f"http://x.org/{'/'.join(held)}{'/odd' if 'wd' not in held else ''}"))
    rows += [(1000 + i, False, f"http://x.org/odd/{i}/wa") for i in range(100)]
    assert sum("odd" in u and b for _, b, u in rows) < 20
    rows += [(2000 + i, True, f"http://x.org/{'/'.join(words[4:])}/odd") for i in range(20)]
    pages = spark.createDataFrame([(i, u) for i, _, u in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, b, _ in rows], "page_id long, bad boolean")
    start = time.time()
    out = {r.page_id: r.verdict for r in url_rules.judge(pages, url_rules.mine(pages, labels, scratch), []).collect()}
    assert time.time() - start < 120
    assert all(out[i] == "block" for i in range(2000, 2020)) and {out[1000 + i] for i in range(100)} == {"allow"}


def test_copies_of_a_long_url_end_in_time(spark, scratch):
    long = "http://bad.org/" + "/".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    rows = [(i, long) for i in range(40)] + [(100 + i, f"http://good.org/{i}/wordaa") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("items", F.lit(1))
    labels = spark.createDataFrame([(i, i < 100) for i, _ in rows], "page_id long, bad boolean")
    start = time.time()
    rules = url_rules.mine(pages, labels, scratch)
    out = {r.page_id: r.verdict for r in url_rules.judge(pages, rules).collect()}
    assert time.time() - start < 60
    assert rules.count() <= 2**url_rules.ITEMS
    assert {out[i] for i in range(40)} == {"block"} and {out[100 + i] for i in range(400)} == {"allow"}


# packing


def test_runs_of_blanks_end_in_time_and_keep_their_ids():
    import public_tokenizers
    import tokenizers

    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = packing.ids_of(public_tokenizers.path("byte_bpe_50k.tiktoken"), True)
    start = time.time()
    for run in (199, 200, 201, 5_000, 99_999):
        text = ("a" + " " * run + "b\n") * (200_000 // run)
        assert ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids
    assert time.time() - start < 30


# pipeline


def test_pipeline_packs_every_id_of_what_it_keeps_once(spark, folder, given):
    rows = given("documents")
    rows += [(7000, None, "en", "src0", 0), (7001, "", None, None, 0), (7002, rows[0][1], "en", "src0", 0)]
    path = folder(documents=(rows, DOCUMENT), labels=(given("labels"), LABEL))
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, path)
        kept.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
        else:
            spans = defaultdict(list)
            for r in docs.collect():
                spans[r.doc_id].append((r.start, r.length, r.doc_tokens))
            assert set(spans) == {r.doc_id for r in before.collect()}
            for own in spans.values():
                at = 0
                for start, length, total in sorted(own):
                    assert start == at
                    at += length
                assert at == total
    assert kept == sorted(kept[:4], reverse=True) + kept[4:] and kept[3] > 0
    assert corpus_pipeline.run(spark, path).count() == kept[4]


def padding(sequence, lengths):
    filled = np.bincount(sequence, lengths).astype(int)
    return int(sum(2048 - n for n in filled if n & (n - 1)))


@pytest.mark.parametrize("most", [300, 700, 2049])
def test_tiers_get_full_windows_of_their_own(most):
    pick = np.random.default_rng(most)
    lengths = np.append(pick.integers(1, most, 4000), [2048] * 20)
    sequence, offset = packing.pack(lengths)
    filled = np.bincount(sequence, lengths).astype(int)
    assert filled.max() <= 2048 and (filled > 0).all()
    order = np.lexsort((offset, sequence))
    new = np.append(True, np.diff(sequence[order]) > 0)
    ends = offset[order] + lengths[order]
    assert (offset[order] == np.where(new, 0, np.append(0, ends[:-1]))).all()
    pieces = np.bincount(sequence)
    if most < 1024:
        # every long window is full but for a few, though short ones took pieces away
        assert padding(sequence, lengths) < 0.004 * lengths.sum()
        assert sum(((filled == t) & (pieces > 1)).sum() for t in (256, 512, 1024)) > 100
    # with one tier there are only long windows
    plain, _ = packing.pack(lengths, (2048,))
    assert padding(sequence, lengths) <= padding(plain, lengths) + 2048


def test_copies_of_one_row_are_dealt_over_groups(spark, documents, scratch, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "GROUP", 50)
    rows = documents([(7, "the same row")] * 400 + [(None, None), (8, "x " * 9000)])
    found = packing.packed(rows, scratch, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    assert len({r.sequence_id >> 32 for r in found if r.doc_id == 7}) > 4
    assert Counter(r.doc_id for r in found)[7] == 400 and sum(r.doc_id is None for r in found) == 1
    own = sorted((r.start, r.length, r.doc_tokens) for r in found if r.doc_id == 8)
    assert sum(length for _, length, _ in own) == own[0][2]


# quality


def plain_score(model, text):
    """The score of one text, all pairs of features one at a time."""
    raw = (text or "").encode()
    words = raw.split()
    x = Counter()
    for bucket, n in Counter(zlib.crc32(w) % quality.BUCKETS for w in words).items():
        x[bucket] = math.log1p(n)
    size = math.sqrt(sum(v * v for v in x.values()))
    x = {i: v / size for i, v in x.items()}
    if words:
        sentence, n = b"!,.?", len(words)
        kinds = [
            lambda b: 65 <= b <= 90,
            lambda b: 48 <= b <= 57,
            lambda b: b in b"\t ",
            lambda b: b in b"\n\r",
            lambda b: b in sentence,
            lambda b: 33 <= b < 127 and not chr(b).isalnum() and b not in sentence,
        ]
        figures = [sum(map(kind, raw)) / len(raw) for kind in kinds]
        lines, hashes = raw.split(b"\n"), [zlib.crc32(w) for w in words]
        figures += [math.log1p(n) / 10, min(1.0, len(raw) / n / 20), len(set(hashes)) / n]
        figures += [sum(a == b for a, b in itertools.pairwise(hashes)) / (n - 1) if n > 1 else 0.0]
        figures += [len(set(lines)) / len(lines), sum(w.isupper() for w in words) / n]
        figures += [sum(w[-1] < 128 and not chr(w[-1]).isalnum() for w in words) / n]
        x |= {quality.BUCKETS + i: v for i, v in enumerate(figures)}
    margin = model.bias + sum(float(model.linear[i]) * v for i, v in x.items())
    for (i, v), (j, w) in itertools.combinations(x.items(), 2):
        margin += float(model.factors[i].astype(float) @ model.factors[j].astype(float)) * v * w
    return 1 / (1 + math.exp(-margin))


def test_quality_query_equals_pairs_one_at_a_time(spark, folder, given):
    rows = [r[:5] for r in given("documents")][:150]
    rows += [(7000, None, "en", "s", 0), (7001, "", None, None, 0), (7002, "ONE", "en", "s", 0), (7003, rows[0][1], "en", "s", 0)]
    labels = [r for r in given("labels") if r[0] in {d[0] for d in rows}]
    path = folder(documents=(rows, DOCUMENT), labels=([r[:3] for r in labels], LABEL))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{path}/labels.parquet"))
    found = QUERIES["op3_quality"](spark, path).collect()
    texts = {r[0]: r[1] for r in rows}
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)
        if len(texts[r.doc_id] or "") < 6000:
            assert r.score == pytest.approx(plain_score(model, texts[r.doc_id]), abs=2e-4)


def test_pipeline_keeps_what_the_query_on_quality_keeps(spark, folder, given):
    rows = given("documents") + [(7000, None, "en", "src0", 0), (7001, "", None, None, 0)]
    path = folder(documents=(rows, DOCUMENT), labels=(given("labels"), LABEL))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    name, stage = corpus_pipeline.STAGES[0]
    kept = stage(spark, docs, path)
    judged = QUERIES["op3_quality"](spark, path).collect()
    assert name == "quality classifier" and kept.columns == docs.columns
    texts = {r[0]: r[1] for r in rows}
    assert {r.doc_id: r.text for r in kept.collect()} == {r.doc_id: texts[r.doc_id] for r in judged if r.predicted}


@pytest.fixture
def large(spark, monkeypatch):
    """Sixteen documents of 1.5 MB, the last with 700 characters of the first. Parts of such texts
    may go to Python one at a time only."""
    text = "array_join(transform(sequence(1, 24000), x -> sha2(cast(id * 100000 + x as string), 256)), '')"
    documents = spark.range(16, numPartitions=1).select(F.col("id").alias("doc_id"), F.expr(text).alias("text"))
    first = documents.where("doc_id = 0").select(F.substring("text", 1001, 700).alias("own")).first()["own"]
    questions = suffix_dedup.questions

    def asked(parts, ask, buckets):
        def counted(batches):
            for batch in batches:
                assert batch.num_rows == 1 or batch.nbytes < 2 << 20, f"{batch.num_rows} parts of {batch.nbytes} bytes"
                yield batch

        return questions(parts.mapInArrow(counted, parts.schema), ask, buckets)

    monkeypatch.setattr(suffix_dedup, "questions", asked)
    return documents.withColumn("text", F.when(F.col("doc_id") == 15, F.concat("text", F.lit(f"/{first}"))).otherwise(F.col("text")))


def test_suffix_dedup_holds_large_parts_one_at_a_time(large, scratch, monkeypatch):
    monkeypatch.setattr(suffix_dedup.Scratch, "drop", lambda self, *names: None)
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.cut_bytes(large, scratch).collect()}
    assert found == {i: (1_536_000, 0, 0) for i in range(15)} | {15: (1_536_701, 700, 1)}
    groups = [g for f in pyarrow.dataset.dataset(f"{scratch.root}/parts", format="parquet").get_fragments() for g in f.row_groups]
    assert sum(g.num_rows for g in groups) == 8 and max(g.total_byte_size for g in groups) < 24 << 20 and len(groups) > 1


def test_pipeline_cuts_large_parts_one_at_a_time(large, spark):
    found = {r["doc_id"]: r["n"] for r in corpus_pipeline.cut_repeats(spark, large, "").select("doc_id", F.length("text").alias("n")).collect()}
    assert found == {i: 1_536_000 for i in range(15)} | {15: 1_536_001}
