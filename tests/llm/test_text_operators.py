"""Text operators against brute-force versions on small fixtures."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from miasma.llm import bpe, decontaminate, html, licenses, lm, quality, queries, reshard, rules, simhash, warc

ODD = ["", None, " \t\n\x0b\x0c\r", "one", "one two", "A b c\x85d \x1ce", "naïve ÉCOLE 日本 😀", "x" * 70_000,
       "Same line.\nSame line.\n\nSame line.", "a b c a b c a b c", "the end.\r\nNext\tline <|endoftext|> 's 12 !!"]


def odd_docs(spark, extra=True):
    """Odd texts, repeated rows, null ids and columns whose names clash with results."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "one"), (None, "one"), (None, None), (50, " ".join(f"w{i % 97}" for i in range(30_000)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    if extra:
        for c in ("n_words", "score", "predicted", "kept", "words", "hashes", "key", "cell", "ids", "n_tokens", "_shard", "block"):
            df = df.withColumn(c, F.lit("old"))
    return df


def words(text):
    return (text or "").encode().lower().split()


# ---- SimHash ----

def brute_fingerprint(text, width=3):
    w = words(text)
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + width]) for i in range(max(len(w) - width + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """{index: smallest id reachable} for (id, fingerprint) rows."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j][1]).count("1") <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        least[root(i)] = min(least.get(root(i), key), key)
    return [least[root(i)] for i in range(len(prints))]


def test_fingerprints_equal_brute_force(spark):
    docs = odd_docs(spark)
    texts = {(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()}
    got = simhash.fingerprints(docs).collect()
    assert len(got) == docs.count()
    assert {(r.id, r.fp & (1 << 64) - 1) for r in got} == texts


@pytest.mark.parametrize("segments,tile", [(1, 7), (4, 5), (4, 2048), (8, 3)])
def test_components_equal_brute_force(spark, segments, tile):
    draw = np.random.default_rng(segments * 10 + tile)
    base = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = [int(x) for x in base]
    for x in base[:20]:  # chains of near copies, and copies
        y = int(x)
        for _ in range(6):
            y ^= 1 << int(draw.integers(64))
            prints += [y, y] if draw.random() < 0.3 else [y]
    prints += [0, 3, (1 << 64) - 1]
    rows = [(i * 7 % 1009, p) for i, p in enumerate(prints)]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in rows]
    table = spark.createDataFrame(signed, "id bigint, fp bigint")
    got = {r.id: r.component for r in simhash.components(table, 2, segments, tile).collect()}
    assert got == {k: c for (k, _), c in zip(rows, brute_components(rows, 2))}


def test_large_group_of_near_copies_is_one_component(spark):
    near = [(i, 1 << i % 64 if i else 0) for i in range(64)] + [(64 + i, i) for i in range(0, 40)]
    table = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in near], "id bigint, fp bigint")
    got = {r.id: r.component for r in simhash.components(table, 2, 4, 8).collect()}
    assert got == {k: c for (k, _), c in zip(near, brute_components(near, 2))}
    edges = simhash.links(table.select("fp").distinct(), 2, 4, 2048).count()
    assert edges < 20 * len(near)


def test_deduplicate_keeps_one_of_each_group_and_rows_without_id(spark):
    docs = odd_docs(spark)
    got = simhash.deduplicate(docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert ids.count(None) == 2 and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect() if r.doc_id is not None]
    assert {i for i in ids if i is not None} == set(brute_components(rows, 2))


def test_empty_tables(spark):
    empty = odd_docs(spark).limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicate(empty).count() == 0
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.scan(empty, items).count() == 0 and decontaminate.clean(empty, items).count() == 0
    assert quality.classify(empty, quality.train(empty, labels)).count() == 0
    assert rules.train(empty, labels) == [] and rules.judge(empty, []).count() == 0
    assert bpe.encode(empty, queries.TOKENIZER).count() == 0
    assert licenses.scan(empty).count() == 0
    assert lm.score(empty, queries.RANKS, __import__("public_tokenizers").PATTERN).count() == 0
    assert html.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


# ---- decontamination ----

def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_hits(text, items, width=13):
    rule = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for key, item in items:
        iw = rule.findall(lower(item))
        k = min(width, len(iw))
        for i in range(len(iw) - k + 1 if k else 0):
            windows.setdefault(tuple(iw[i:i + k]), set()).add("" if key is None else str(key))
    w, covered, found = rule.findall(lower(text)), set(), set()
    for k in {len(x) for x in windows}:
        for p in range(len(w) - k + 1):
            hit = windows.get(tuple(w[p:p + k]))
            if hit:
                covered |= set(range(p, p + k))
                found |= hit
    return len(w), len(covered), sorted(found)


@pytest.fixture
def tainted(spark):
    passage = " ".join(f"Item{i}" for i in range(30))
    items = [(1, passage), (10, passage + " tail"), (2, "short Item"), (9, ""), (None, None), (3, "日本 one Two three"), (1, passage)]
    docs = [(0, f"start {passage.upper()}; end"), (1, " ".join(["filler"] * 900) + " " + passage), (2, "a short, item b"),
            (3, None), (4, ""), (5, "x 日本-ONE two\nthree y"), (6, " ".join(f"item{i}" for i in range(12))),
            (7, passage + " " + passage), (8, "clean text only"), (8, "clean text only"), (None, passage)]
    return (spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("key", F.lit(1)).withColumn("start", F.lit(2)).withColumn("width", F.lit(3)),
            spark.createDataFrame(items, "item_id bigint, text string").withColumn("window", F.lit(1)), docs, items)


@pytest.mark.parametrize("bound", [200_000, 3])
def test_decontamination_equals_brute_force(tainted, bound, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", bound)
    docs, items, rows, item_rows = tainted
    got = decontaminate.report(decontaminate.scan(docs, items)).collect()
    expected = []
    for key, text in rows:
        n, hit, found = brute_hits(text, item_rows)
        expected.append((key, n, hit, found, hit > 0 and 20 * hit >= n))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got], key=order) == sorted(expected, key=order)


def test_clean_removes_documents_or_spans(tainted):
    docs, items, rows, item_rows = tainted
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    clean = [(k, t) for k, t in rows if not (brute_hits(t, item_rows)[1] and 20 * brute_hits(t, item_rows)[1] >= brute_hits(t, item_rows)[0])]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(clean)
    cut = {r.doc_id: r.text for r in decontaminate.clean(docs, items, remove="spans").collect()}
    assert cut[0] == "start end" and cut[8] == "clean text only" and cut[3] is None
    assert cut[2] == "a b" and cut[5] == "x y"


# ---- rules ----

def brute_statistics(text):
    text = text or ""
    w = text.encode().split()
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_rule_statistics_equal_brute_force(spark):
    docs = odd_docs(spark).withColumn("n_symbols", F.lit("old"))
    got = rules.judge(docs, []).collect()
    assert len(got) == docs.count()
    for r in got:
        expected = brute_statistics(r.text)
        assert tuple(r[c] for c in rules.BASE) == expected
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert r.base_failed == failed and r.kept == (not failed)
    assert rules.select_good(docs, []).columns == docs.columns


def test_decision_list_is_learned_and_emitted_as_expressions(spark):
    draw = np.random.default_rng(2)
    x = draw.random((900, len(rules.STATISTICS)))
    bad = (x[:, 2] > 0.8) | ((x[:, 4] < 0.3) & (x[:, 5] > 0.6))
    found = rules.learn(x, bad)
    assert 2 <= len(found) <= 6
    covered = np.zeros(len(x), bool)
    for rule in found:
        covered |= rules._covers(rule, x)
    assert (covered == bad).mean() > 0.95
    table = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{s} double" for s in rules.STATISTICS))
    verdicts = [r[0] for r in table.select(rules.verdict(found)).collect()]
    assert (np.array(verdicts) == ~covered).all()
    assert rules.learn(x, np.zeros(len(x), bool)) == [] and rules.learn(x[:0], bad[:0]) == []


# ---- classifier ----

def labelled(spark, n=240):
    draw = np.random.default_rng(4)
    vocabulary = ["alpha", "beta", "gamma", "delta", "omega"]
    rows, marks = [], []
    for i in range(n):
        w = list(draw.choice(vocabulary, 40))
        if i % 4 == 0:
            w = [x + "###" for x in w]
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 4 != 0), 0))
    marks += [(0, None, 0), (None, 1, 0)]
    return (spark.createDataFrame(rows, "doc_id bigint, text string"),
            spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int"))


def test_classifier_learns_without_held_out_rows(spark):
    docs, labels = labelled(spark)
    texts, marks = quality.training_sample(docs, labels)
    held = {i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert len(texts) == len(marks) == 240 - len(held)
    weights = quality.train(docs, labels)
    got = quality.classify(docs, weights).collect()
    assert all(r.predicted == int(r.doc_id % 4 != 0) and 0 <= r.score <= 1 for r in got)
    assert len(quality.training_sample(docs, labels, max_rows=10)[0]) == 10
    assert quality.select_good(docs, weights).count() == 180


def test_classifier_learns_from_what_fits_behind_a_long_text(spark):
    docs, labels = labelled(spark)
    whole, marks = quality.training_sample(docs, labels)
    longest = max(map(len, whole)) + 1
    long = quality.training_sample(docs, labels, max_rows=1)[0][0].decode()
    docs = docs.withColumn("text", F.when(F.col("text") == long, F.repeat("text", longest)).otherwise(F.col("text")))
    expected = [(t, m) for t, m in zip(whole, marks) if t.decode() != long]
    got = quality.training_sample(docs, labels, max_bytes=sum(len(t) for t, _ in expected))
    assert list(zip(*got)) == expected and len(expected) > 100
    with pytest.raises(ValueError):
        quality.training_sample(docs, labels, max_bytes=1)


def test_classifier_scores_odd_texts_and_equals_a_slow_dot_product(spark):
    docs = odd_docs(spark)
    weights = np.random.default_rng(1).normal(size=(1 << quality.BITS) + 1)
    got = quality.classify(docs, weights)
    assert got.columns == [c for c in docs.columns if c not in ("score", "predicted")] + ["score", "predicted"]
    for r in got.collect():
        total = weights[-1]
        for numbers, _ in quality.features([(r.text or "").encode()], quality.Words()):
            total += sum(weights[int(i)] for i in numbers) / max(len(numbers), 1)
        assert r.score == pytest.approx(1 / (1 + np.exp(-total)), rel=1e-6)


# ---- BPE ----

def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.TOKENIZER)
    docs = odd_docs(spark)
    rows = bpe.encode(docs, queries.TOKENIZER, outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))
    for r in rows.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decode(rows, queries.TOKENIZER).collect()
    assert all(r.decoded == (r.text or "") for r in back)


def test_bpe_in_small_batches_gives_the_same_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i, None if i == 3 else f"text {i} " * (i % 7) + "é<|endoftext|>") for i in range(60)], "doc_id long, text string")
    names = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    whole = bpe.encode(docs.coalesce(1), queries.TOKENIZER, outputs=names).collect()
    assert bpe.encode(docs.coalesce(1), queries.TOKENIZER, outputs=names, batch_bytes=100).collect() == whole
    import corpus_pipeline
    asked = []
    monkeypatch.setattr(corpus_pipeline.bpe, "encode", lambda df, *args, **options: asked.append(options) or df)
    corpus_pipeline.bpe_encoding(spark, docs, "")
    assert asked[0]["batch_bytes"] < bpe.BATCH_BYTES


def test_bpe_of_random_texts_equals_the_library():
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(queries.TOKENIZER), bpe.Encoder(open(queries.TOKENIZER, encoding="utf-8").read())
    draw = np.random.default_rng(9)
    pieces = ["a", "th", "e", " ", "  ", "\n", "'s", "'LL", "é", "日本", "😀", "12", "!!", "#", "ing", "\x85", "<|endoftext|>", "aaaa", "ſ"]
    for _ in range(1500):
        text = "".join(draw.choice(pieces, draw.integers(0, 25)))
        ids = [int(i) for e in next(encoder.batch([text])) for i in e[1].split(",")]
        assert ids == library.encode(text, add_special_tokens=False).ids


# ---- WARC ----

def test_warc_round_trip(spark):
    big, other = "<p>" + "x" * 300, "y" * 99
    rows = [(5, "http://a/", big), (2, "http://b/", big), (9, None, big), (1, "u\r\nInjected: 1", other), (3, "v", other),
            (4, "w", None), (6, "x", ""), (2, "http://b2/", big), (None, "n", big), (None, "m", "z" * 200), (7, "é", "日本" * 40), (8, "f", "日本" * 40)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).withColumn("first", F.lit(1))
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    expected = Counter()
    for i, _, payload in rows:
        data = (payload or "").encode()
        ids = [j for j, _, p in rows if (p or "").encode() == data and j is not None]
        revisit = len(data) >= 100 and bool(ids) and i != min(ids)
        expected[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", min(ids) if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected


def test_warc_reads_only_what_is_selected(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 50) for i in range(200)], "page_id bigint, url string, html string")
    index = warc.write(pages, f"file://{tmp_path}/archives", archive_bytes=4000)
    assert index.select("file").distinct().count() > 3
    some = warc.read(index.filter("page_id % 50 = 7")).collect()
    assert sorted((r.page_id, r.payload.decode()) for r in some) == [(i, f"page {i} " * 50) for i in (7, 57, 107, 157)]
    assert warc.runs([(10, 5), (0, 5), (500, 5), (15, 5)], 100) == [(0, 20, [(0, 5), (10, 5), (15, 5)]), (500, 505, [(500, 5)])]


# ---- licenses ----

def test_licenses_are_told_apart_by_wording(spark):
    docs = spark.createDataFrame([
        (1, "text\nReleased under the MIT License.\nmore text"), (2, "Licensed under the Apache License, Version 2.0."),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "this work is licensed under the GNU General Public License, version 2"), (5, "Licensed under CC BY-NC 4.0."),
        (6, "Licensed under CC BY 4.0."), (7, "We license our staff to sing and to dance on Sundays."), (8, None), (9, ""),
        (10, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and\nassociated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including\nwithout limitation "
             "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to "
             "permit persons to whom the Software is furnished to do so, subject to the\nfollowing conditions: The above copyright "
             "notice and this permission notice shall be included in all\ncopies or substantial portions of the Software."),
        (2, "Licensed under the Apache License, Version 2.0.")], "doc_id bigint, text string").withColumn("id", F.lit(1)).withColumn("line", F.lit(1))
    got = sorted((r.id, r.license) for r in licenses.scan(docs).collect())
    assert got == [(1, "MIT"), (2, "Apache-2.0"), (2, "Apache-2.0"), (3, "GPL-3.0"), (4, "GPL-2.0"), (5, "CC-BY-NC-4.0"), (6, "CC-BY-4.0"), (10, "MIT")]
    exact = {r.id: r.differences for r in licenses.scan(docs).collect()}
    assert all(d == [] for d in exact.values())


@pytest.mark.parametrize("text,expected", [
    ("Copyright 2020 Acme Inc. All rights reserved.", [(0, 1, "all-rights-reserved", "All rights reserved.")]),
    ("One.\nThis article is licensed under CC BY 4.0.", [(1, 1, "CC-BY-4.0", "licensed under CC BY 4.0.")]),
    ("The project Foo Bar is released under the MIT License.", [(0, 1, "MIT", "released under the MIT License.")]),
    ("Code is released under the MIT License. Texts are licensed under CC BY 4.0, and that is all there is to say. All rights reserved.",
     [(0, 1, "MIT", "released under the MIT License."), (0, 1, "CC-BY-4.0", "licensed under CC BY 4.0,"), (0, 1, "all-rights-reserved", "All rights reserved.")]),
    ("a b c d. Released\nunder the MIT\nLicense. e f g", [(0, 3, "MIT", "Released under the MIT License.")]),
    ("copyright", []), ("A license, rights reserved by no one.", []),
])
def test_licenses_are_found_within_a_line(text, expected):
    assert [r[:4] for r in licenses.Scanner().scan(text)] == expected


_GNU = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} License as published by "
        "the Free Software Foundation; either version {} of the License, or (at your option) any later version.")


@pytest.mark.parametrize("text,expected", [
    (_GNU.format("program", "General Public", "2"), ["GPL-2.0"]), (_GNU.format("program", "General Public", "3"), ["GPL-3.0"]),
    (_GNU.format("program", "Affero General Public", "3"), ["AGPL-3.0"]), (_GNU.format("library", "Lesser General Public", "2.1"), ["LGPL-2.1"]),
    (_GNU.format("library", "Library General Public", "2"), ["LGPL-2.0"]), (_GNU.format("program", "General Public", "9"), []),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", ["CC-BY-SA-3.0"]),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 7.0 International License.", []),
    ("SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0"]), ("SPDX-License-Identifier: ISC", ["ISC"]), ("SPDX-License-Identifier: Foo-1.0", []),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met:", ["BSD-2-Clause OR BSD-3-Clause"]),
    ("under the Eclipse Public License 2.0, a license", ["EPL-2.0"]), ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
    ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
])
def test_licenses_that_differ_in_name_or_version_are_told_apart(text, expected):
    assert [r[2] for r in licenses.Scanner().scan(text)] == expected


# ---- HTML ----

PAGE = """<html><head><title>x</title><style>p{}</style></head><body><header class="site-header"><h1>Site</h1></header>
<ul class="menu"><li><a href="/">Home</a><li><a href="/b">B</a></ul><div class="wrapper content-with-sidebar">
<div id="sidebar"><p>Some, long, side bar, text here that is long enough to count, really, it is, so there.</p></div>
<div class="post-body"><h1>Title</h1><p>First para, with &nbsp;commas, and<br>break.</p><div class="share">share me</div>
<section><h2>Sub</h2><p>Short.</p><ul><li>one<li>two</ul></section><p>a < b &amp; c &lt;tag&gt;</p><div class="cookie-notice">We
use cookies</div></div><div class="comments"><p>I disagree, strongly, with, all, of, this, long comment text.</p></div></div>
<script>var a = "<p>no</p>";</script><footer>(c)</footer></body></html>"""


@pytest.mark.parametrize("page,expected", [
    (PAGE, "Title\n\nFirst para, with commas, and break.\n\nSub\n\nShort.\n\none\n\ntwo\n\na < b & c <tag>"),
    ("<article><h1>T</h1><p><b>One.<br><p>Two</article><footer>f</footer>", "T\n\nOne.\n\nTwo"),
    ("<body><nav><a href=x>a</a></nav><p>One.</p><p>Two, three.</p><form><p>form, text</p></form>", "One.\n\nTwo, three."),
    ("<main><article class='post'><p>Body, text.</p></article><article class='comment'><p>Mine, too, is, long, enough, to count</p></article>"
     "<div id='readerComments'><p>No, no, no.</p></div></main>", "Body, text."),
    ("<ul><li><a href=/>Home</a><li><a href=/a>A</a><li><a href=/b>B</a></ul><div id=content><h1>T</h1><p>One, two.</p><p>Three.</p></div>",
     "T\n\nOne, two.\n\nThree."),
    ("just text\n here", "just text here"), ("", ""), (None, ""), ("<div>" * 5000 + "x", "x"),
    ("<p>1 < 2 <3 &eacute;&#233;&#x1F600;</p><!-- c --><p title='a>b'>q</p>", "1 < 2 <3 éé😀\n\nq"),
])
def test_main_text(spark, page, expected):
    rows = spark.createDataFrame([(1, "u", page, "old")], "page_id bigint, url string, html string, text string")
    got = html.extract(rows).collect()
    assert [(r.page_id, r.url, r.text, r.n_chars) for r in got] == [(1, "u", expected, len(expected))]


_LONG = "This paragraph is long enough to be one of an article, with commas, and goes on for some time. " * 4


@pytest.mark.parametrize("page,kept,gone", [
    (f"<article><h1>T</h1><p>{_LONG}</p><h2 id='related-work'>Related</h2><p>Two.</p><h2 id='search'>Searching</h2>"
     f"<section id='discussion'><h2>Discuss</h2><p>{_LONG}</p></section><div id='legal'><p>{_LONG}</p></div>"
     f"<div class='commentary'><p>{_LONG}</p></div><div class='ad'>Buy it</div></article>",
     ["T", _LONG.strip(), "Related", "Two.", "Searching", "Discuss", _LONG.strip(), _LONG.strip(), _LONG.strip()], "Buy"),
    (f"<main><div class='social'><p>{_LONG}</p></div><ul class='related'>" + "<li><a href=/>Another article, with a name</a>" * 12 + "</ul></main>",
     [_LONG.strip()], "Another"),
    (f"<body><form id='aspnetForm'><input name=x><select><option>o</select><div id='content'><h1>T</h1><p>{_LONG}</p><p>Two.</p>"
     f"<form><p>Mail</p></form></div></form></body>", ["T", _LONG.strip(), "Two."], "Mail"),
    (f"<body><div><p>{_LONG}</p></div><form><p>Your mail, please.</p></form></body>", [_LONG.strip()], "mail"),
])
def test_names_and_forms_do_not_take_away_the_article(page, kept, gone):
    got = html.main_text(page)
    assert got.split("\n\n") == kept and gone not in got


@pytest.mark.parametrize("name", "legal-guide popular-science discussion social-history page-banner search-engines tags".split())
def test_container_named_like_its_subject_is_the_article(name):
    page = f"<body><h1>T</h1><div class='{name}'><p>{_LONG}</p><p>{_LONG}</p></div><div class='footer'><p>{_LONG}</p></div></body>"
    assert html.main_text(page) == f"T\n\n{_LONG.strip()}\n\n{_LONG.strip()}"
    # Beside an article the same name tells.
    for article in (f"<div class='content'><p>{_LONG}</p></div>", f"<article><p>{_LONG}</p></article>"):
        assert html.main_text(f"<body>{article}<div class='{name}'><p>{_LONG}</p></div></body>") == _LONG.strip()


def test_inline_elements_stay_within_a_sentence():
    page = ("<article><p>Let <math><mi>x</mi><annotation>x^2</annotation></math> be, <label>one</label> or <button>two</button>.</p>"
            "<p><button>Share</button></p><p><label>Name</label> here <input></p></article>")
    assert html.main_text(page) == "Let x be, one or two.\n\nhere"


@pytest.mark.parametrize("start", ["<ul><li>", "<div class='x'>", "<div class='tags'>t", "<b>", "<ul><li>word, </p></div>", "<table><td>w"])
def test_deep_pages_take_linear_time(start):
    began = time.process_time()
    html.main_text(start * 20_000 + _LONG)
    assert time.process_time() - began < 10  # a walk of the subtree at every level would take minutes


def naive_best(root):
    """The container with most points, each worked out from all blocks anew."""
    found = html.blocks(root)
    first = {"p", "pre", "li", "td", "th", "dd", "dt", "blockquote", *html.HEADINGS}
    totals, order = {}, []
    for text, holder, linked in found:
        points = 0.5 if holder.tag in html.HEADINGS else 1 + text.count(",") + min(len(text) / 100, 3)
        above = holder.parent if holder.tag in first and holder.parent else holder
        level = 1
        while above is not None:
            total = totals.setdefault(id(above), [above, 0.0, 0, 0])
            if level <= 3:
                total[1] += points / level
                if above not in order:
                    order.append(above)
            total[2] += len(text)
            total[3] += linked
            above, level = above.parent, level + 1
    value = {id(n): p * (1 - k / max(c, 1)) for n, p, c, k in totals.values()}
    return max(order, key=lambda n: value[id(n)]) if order else root


def test_scores_and_sizes_equal_a_plain_version():
    draw = np.random.default_rng(4)
    parts = ["<div>", "</div>", "<p>", "</p>", "<a href=x>", "</a>", "<ul>", "<li>", "</ul>", "<b>", "</b>", "<h2>", "</h2>", "<script>z</script>",
             "<br>", "one, two ", "a longer text, with commas, and words. ", "<td>", "<table>", "</table>", "<label>l</label>"]
    for _ in range(400):
        root = html.parse("".join(parts[i] for i in draw.integers(0, len(parts), 60)))
        html.measure(root)
        for node, _, entering in list(html._walk(root)):
            if entering and isinstance(node, html.Node):
                inner = [(n, e) for n, _, e in html._walk(node)]
                never = linked = size = size_linked = 0
                for n, e in inner:
                    if isinstance(n, str):
                        size += 0 if never else len("".join(n.split()))
                        size_linked += len("".join(n.split())) if linked and not never else 0
                    elif n.tag == "a":
                        linked += 1 if e else -1
                    elif n.tag in html.NEVER_TEXT:
                        never += 1 if e else -1
                assert (node.size, node.size_linked) == (size, size_linked)
        expected = naive_best(root)
        assert html.score(root) is expected


@pytest.mark.parametrize("names", [["_id", "_hash", "_row", "_stays", "_spans", "_copy"], ["SCORE", "Predicted", "N_Tokens", "IDS", "__ID", "_Id", "N_CHARS", "Html"]])
def test_columns_of_clashing_names_do_no_harm(spark, names):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (3, "other words"), (None, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, " ".join(text.split()[:13]))], "item_id bigint, text string")
    for c in names:
        docs = docs.withColumn(c, F.lit("old"))
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3]
    for remove, n in (("documents", 2), ("spans", 5)):
        kept = decontaminate.clean(docs, bench, remove=remove)
        assert kept.columns == docs.columns and kept.count() == n and kept.filter("text LIKE '%alpha%'").count() == 0
    weights = np.zeros((1 << quality.BITS) + 1)
    assert quality.classify(docs, weights).agg(F.sum("score"), F.sum("predicted")).first()[:] == (2.5, 5)
    assert bpe.encode(docs, queries.TOKENIZER).filter("size(ids) = n_tokens").count() == 5
    pages = docs.drop("Html", "text").withColumn("html", F.lit("<p>A page."))
    assert html.extract(pages).agg(F.sum("n_chars")).first()[0] == 35


# ---- resharding ----

def test_transfers_move_the_fewest_bytes():
    draw = np.random.default_rng(3)
    for _ in range(40):
        sizes = [int(x) for x in draw.integers(0, 50, draw.integers(1, 7))]
        new = int(draw.integers(1, 8))
        capacities = reshard.even(sum(sizes), new)
        flow = reshard.transfers(sizes, capacities)
        assert [sum(row) for row in flow] == sizes
        assert [sum(row[j] for row in flow) for j in range(new)] == capacities
        stays = sum(min(s, c) for s, c in zip(sizes, capacities))
        assert sum(flow[i][i] for i in range(min(len(sizes), new))) == stays


def test_resharding_keeps_rows_and_balances_bytes(spark, path):
    draw = np.random.default_rng(8)
    rows = [(i, "é" * int(draw.integers(0, 400))) for i in range(4000)] + [(7, None), (None, "x"), (7, "dup"), (7, "dup")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_file", F.lit("a+b")).withColumn("shard", F.lit(1))
    docs.repartition(40).write.parquet(path)
    docs = spark.read.parquet(path)
    layout = reshard.reshard(docs, 8, 3)
    assert layout.filter("rewritten").select("shard").count() <= 8 * 12
    assert layout.filter("NOT rewritten").count() >= 1
    got = reshard.read_layout(docs, layout).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert got[0]._file == "a+b"
    by = {}
    for r in got:
        by.setdefault(r._shard, []).append(r)
    sizes = [sum(len((r.text or "").encode()) + 1 for r in by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) < 800
    assert all(sorted(r._slot for r in by[s]) == list(range(len(by[s]))) for s in range(8))


def test_resharding_of_nothing_and_of_one_row(spark, path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(path)
    empty = spark.read.parquet(path)
    assert reshard.read_layout(empty, reshard.reshard(empty, 8, 6)).count() == 0
    spark.createDataFrame([(1, "a")], "doc_id bigint, text string").write.parquet(path + "-1")
    one = spark.read.parquet(path + "-1")
    assert [(r._shard, r._slot) for r in reshard.read_layout(one, reshard.reshard(one, 8, 6)).collect()] == [(0, 0)]


# ---- language model ----

def test_attention_gradients():
    net = lm.Attention(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    draw = np.random.default_rng(0)
    x, y = draw.integers(0, 50, (3, 9)), draw.integers(0, lm.CLASSES, (3, 9))
    _, g = net.gradients(x, y)
    for name, value in net.p.items():
        at = tuple(int(draw.integers(n)) for n in value.shape) if name != "embed" else (int(x[0, 0]), 3)
        kept = value[at]
        ends = []
        for step in (1e-5, -1e-5):
            value[at] = kept + step
            ends.append(net.gradients(x, y)[0])
        value[at] = kept
        assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(g[name][at], rel=2e-3, abs=1e-7), name


def test_windows_score_every_place_once():
    lengths = np.array([1, 2, lm.WINDOW, lm.WINDOW + 1, 100, 1])
    begin, filled, first = lm.windows(lengths)
    seen = np.zeros(lengths.sum(), int)
    for b, f, s in zip(begin, filled, first):
        assert f <= lm.WINDOW
        seen[b + s:b + f] += 1
    assert (seen == 1).all()


def test_lm_counts_and_base_equal_brute_force(spark, path):
    docs = odd_docs(spark).unionByName(odd_docs(spark).limit(0))
    docs.repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    rows = docs.select("doc_id", "text").collect()
    held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in rows]
    counts = Counter()
    for r, h in zip(rows, held):
        if not h:
            counts.update([*words(r.text), None])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for r, h in zip(rows, held):
        t = [*words(r.text), None]
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        expected.append((r.doc_id, h, len(t), sum(counts[w] > 0 for w in t), n, round(base, 6)))
    got = lm.score(docs, queries.RANKS, __import__("public_tokenizers").PATTERN).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted([(r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], key=order) == sorted(expected, key=order)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_scores_do_not_depend_on_the_batch():
    draw = np.random.default_rng(6)
    counts = np.append(draw.integers(1, 30, 60), 5)
    begins = np.append(np.arange(60) < 30, True)
    model = lm.Scorer(counts, np.where(begins, counts, 0), begins, 0.1, [draw.integers(0, 60, 200)])
    # Texts of words that each have a beginning and some inner subwords.
    texts, spans = [], []
    for n in (3, 1, 40):
        ids, own = [], []
        for _ in range(n):
            k = int(draw.integers(0, 3))
            ids += [int(draw.integers(30)), *map(int, draw.integers(30, 60, k))]
            own.append(k + 1)
        texts.append(np.array([*ids, 60]))
        spans.append(np.array([*own, 1]))
    known = [np.maximum(draw.integers(-5, 5, len(s)), 0) for s in spans]
    whole = model.score(np.concatenate(texts), np.array([len(t) for t in texts]), np.concatenate(spans), np.concatenate(known), batch=2)
    single = np.concatenate([model.score(t, np.array([len(t)]), s, c) for t, s, c in zip(texts, spans, known)])
    assert whole == pytest.approx(single, abs=1e-4) and (whole < 0).all()


def test_lm_is_fitted_though_the_only_training_text_is_long(spark, path, monkeypatch):
    fitted = []
    monkeypatch.setattr(lm.Attention, "fit", lambda self, inputs, targets: fitted.append(len(targets)))
    long = " ".join(f"word{i % 90}" for i in range(350_000))
    assert len(long) > 2 << 20
    docs = spark.createDataFrame([(i, long if i == 2 else "held out") for i in range(60) if i == 2 or zlib.crc32(str(i).encode()) % 5 == 1],
                                 "doc_id bigint, text string")
    assert zlib.crc32(b"2") % 5 != 1
    docs.write.parquet(path)
    got = lm.score(spark.read.parquet(path), queries.RANKS, __import__("public_tokenizers").PATTERN).collect()
    assert fitted == [lm.SAMPLE_CHUNKS * lm.CHUNK] and all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_steps_and_means_equal_plain_ones(spark):
    draw = np.random.default_rng(2)
    net, given = lm.Attention(), lm.Attention()
    adam, first, second = lm.Adam(net), {}, {}
    for step in range(1, 6):
        x, y = draw.integers(0, lm.INPUTS, (7, lm.WINDOW)), draw.integers(0, lm.CLASSES, (7, lm.WINDOW))
        for name, g in given.gradients(x, y)[1].items():
            first[name] = 0.9 * first.get(name, 0) + 0.1 * g
            second[name] = 0.99 * second.get(name, 0) + 0.01 * g * g
            given.p[name] -= 1e-3 * first[name] / (1 - 0.9 ** step) / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-8)
        adam(x, y, 1e-3)
    assert np.allclose(net.flat, given.flat, atol=1e-5)
    # Tasks' weights, added up in groups, are their mean by numbers of windows.
    weights = draw.standard_normal((40, 5)).astype(np.float32)
    rows = [(i, i + 1, weights[i].tobytes()) for i in range(40)]
    got = (spark.createDataFrame(rows, "task bigint, n bigint, weights binary").repartition(4, F.col("task") % 4)
           .mapInArrow(lm._weighted_sums, "task bigint, n bigint, weights binary").collect())
    assert sum(r.n for r in got) == 820
    assert sum(np.frombuffer(r.weights) for r in got) / 820 == pytest.approx(np.average(weights, axis=0, weights=range(1, 41)))


def test_lm_chunks_hold_every_subword_of_the_training_documents(spark, path):
    odd_docs(spark).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    public = __import__("public_tokenizers")
    file = open(queries.RANKS).read()
    encoding = lm.tokenizer(file, public.PATTERN)
    expected = Counter()
    for r in docs.collect():
        if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 != 1:
            expected.update([*(i for w in words(r.text) for i in encoding.encode_ordinary(" " + w.decode())), encoding.n_vocab])
    got = Counter()
    rows = lm._blocks(docs, "doc_id", "text")
    for r in lm._chunks(rows, spark.sparkContext.broadcast(file), public.PATTERN, encoding.n_vocab).collect():
        got.update(np.frombuffer(r.ids, np.int32)[1:].tolist())
    assert got == expected


def test_lm_subwords_of_many_words_are_those_of_each(monkeypatch):
    public, file = __import__("public_tokenizers"), open(queries.RANKS).read()
    plain = [b"plain", b"don't", b"'s", b"x1.y", "h\u00e9".encode(), b"\x1c\x00", b"a", b"plain"]
    odd = [b"", "a\u00a0b".encode(), "\u00a0".encode(), "\u3000c".encode(), "d\u2003".encode(), b"\xff"]
    encoding = lm.tokenizer(file, public.PATTERN)
    subwords = lm.Subwords(file, public.PATTERN)
    texts = []
    subwords.encode = lambda text: texts.append(text) or encoding.encode_ordinary(text)
    for some, n in (([*plain[:5], *plain[6:]], 1), (plain, None), (odd, None), (plain + odd, None), ([], 0)):
        texts.clear()
        ids, lengths = subwords(some)
        expected = [encoding.encode_ordinary(" " + w.decode("utf-8", "replace")) if w else [] for w in some]
        assert lengths.tolist() == list(map(len, expected)) and ids.tolist() == [i for x in expected for i in x]
        assert n is None or len(texts) == n
    # A rule that does not part words at each space.
    assert lm.Subwords(file, r"[\s\S]+")([b"a", b"b"])[1].tolist() == [1, 1]
    # Long lists go in pieces.
    monkeypatch.setattr(lm, "WORDS_IN_A_TEXT", 3)
    assert lm.Subwords(file, public.PATTERN)(plain)[0].tolist() == [i for w in plain for i in encoding.encode_ordinary(" " + w.decode())]


def test_lm_learns_from_training_documents_beyond_the_sample(spark, path, monkeypatch):
    monkeypatch.setattr(lm, "SAMPLE_CHUNKS", 1)
    monkeypatch.setattr(lm.Attention, "fit", lambda self, inputs, targets: None)
    learned, whole = [], lm._learned

    def watched(chunks, model):
        before = {k: v.copy() for k, v in model.net.p.items()}
        sizes = [len(np.frombuffer(r.ids, np.int32)) - 1 for r in chunks.collect()]
        table = lm._neighbours(chunks, counts := model_counts(chunks))
        model = whole(chunks, model)
        learned.append((sum(sizes), table, counts, any((before[k] != v).any() for k, v in model.net.p.items())))
        return model

    def model_counts(chunks):
        return np.bincount(np.concatenate([np.frombuffer(r.ids, np.int32)[1:] for r in chunks.collect()]), minlength=60_000)

    monkeypatch.setattr(lm, "_learned", watched)
    rows = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(900))) for i in range(40)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(path)
    lm.score(spark.read.parquet(path), queries.RANKS, __import__("public_tokenizers").PATTERN).count()
    (subwords, table, counts, moved), = learned
    assert subwords > 2 * lm.CHUNK and counts.sum() == subwords and moved
    # All subwords are frequent here, so each stands once before and once after another.
    assert (counts > 0).sum() <= lm.AROUND and table.sum() == 2 * subwords
