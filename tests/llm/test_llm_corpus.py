"""Packing, mixing, quality, licences, URL filters, fingerprints and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_samples import (  # noqa: F401
    LONG,
    ODD,
    lower,
    make_docs,
    odd,
    sample,
    spaced_words,
    workers_find_the_package,
)
from pyspark.sql import functions as F

import corpus_pipeline
from topicstream.llm import (
    exact_dedup,
    fingerprints,
    licenses,
    mixing,
    near_dedup,
    packing,
    quality,
    queries,
    tokens,
    url_filters,
)

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(queries.tokenizer_path())
    return found


# Queries with SQL


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = duck.sql(queries.ORACLES[name])
    found = queries.QUERIES[name](spark, SF)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {f.name: kinds[f.dataType.simpleString()] for f in found.schema} == dict(
        zip(result.columns, map(str, result.types))
    )
    rows = sorted((tuple(row[c] for c in result.columns) for row in found.collect()), key=repr)
    assert rows == sorted(result.fetchall(), key=repr) and rows


def test_registered():
    assert [f"op{n}" for n in range(1, 11)] == sorted((n.split("_")[0] for n in queries.QUERIES), key=lambda x: int(x[2:]))
    assert set(queries.ORACLES) < set(queries.QUERIES)


# Packing


def test_fast_ids_are_those_of_the_tokenizer(tokenizer, sample):
    texts = [row.text for row in sample.collect()] + [t or "" for _, t, _ in ODD]
    texts += ["<|endoftext|> don't  we'll\n\n x \t\u3000y\xa0z", "\x1c\x1d", " " * 60_000 + "x", "१२३ ²³ Ⅷ é́"]
    encoder = tokens.encoder(queries.tokenizer_path())
    assert encoder.fast is not None
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_places(pieces, capacity):
    """Every sequence is filled from 0 without gaps and holds no more than ``capacity``."""
    sequences = defaultdict(list)
    for sequence, offset, length in pieces:
        sequences[sequence].append((offset, length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([1, 7, 32, 100]), st.lists(st.integers(1, 100), max_size=80), st.integers(1, 5))
def test_plan_places_every_piece_once(capacity, lengths, times):
    lengths = [min(length, capacity) for length in lengths] * times
    counts = {length: lengths.count(length) for length in set(lengths)}
    slots = packing.plan(counts, capacity)
    ordered = np.array(sorted(lengths), np.int64)
    ranks = np.concatenate([np.arange(counts[n]) for n in sorted(counts)]) if counts else np.zeros(0, np.int64)
    sequence, offset = packing.locate(slots, ordered, ranks)
    used = check_places(zip(sequence.tolist(), offset.tolist(), ordered.tolist()), capacity)
    assert used >= -(-sum(lengths) // capacity)
    bins = []  # no worse than best fit alone
    for length in sorted(lengths, reverse=True):
        room = min((r for r in bins if r >= length), default=None)
        if room is not None:
            bins.remove(room)
        bins.append((capacity if room is None else room) - length)
    assert used <= max(len(bins), 1 + len(bins) * 1.1)


def test_plan_rejects_pieces_that_do_not_fit():
    with pytest.raises(ValueError, match="a piece of 9"):
        packing.plan({9: 1}, 8)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_round_trip(odd, tokenizer, capacity):
    rows = packing.pack_documents(odd, queries.tokenizer_path(), capacity=capacity).collect()
    documents = defaultdict(list)
    for row in rows:
        assert row.length * 4 == len(row.ids) and 0 < row.length <= capacity
        documents[row.doc_id].append(row)
    texts = defaultdict(list)
    for i, text, _ in ODD:
        texts[i].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END])
    assert documents.keys() == texts.keys()
    for i, wanted in texts.items():
        if len(wanted) > 1:  # repeated ids: count the ids
            assert sum(r.length for r in documents[i]) == sum(map(len, wanted))
            continue
        pieces = sorted(documents[i], key=lambda r: r.piece)
        ids = np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist()
        assert ids == wanted[0]
        assert [r.start for r in pieces] == [sum(x.length for x in pieces[:k]) for k in range(len(pieces))]
        assert all(r.length == capacity for r in pieces[1:])
    used = check_places([(r.sequence_id, r.offset, r.length) for r in rows], capacity)
    total = sum(r.length for r in rows)
    assert used <= -(-total // capacity) + 2


def test_packing_query(spark, tokenizer, sample):
    rows = queries.op1_best_fit_packing(spark, SF).collect()
    texts = {row.doc_id: row.text for row in sample.collect()}
    for row in rows:
        ids = tokenizer.encode(texts[row.doc_id] or "", add_special_tokens=False).ids + [0]
        part = np.array(ids[row.start : row.start + row.length], "<u4")
        assert len(part) == row.length and zlib.crc32(part.tobytes()) == row.ids_crc32
    assert sum(r.length for r in rows if r.doc_id == 0) == len(tokenizer.encode(texts[0]).ids) + 1
    assert packing.pack_documents(sample.limit(0), queries.tokenizer_path()).collect() == []


# Mixing


def water_filled(sizes, weights, share):
    targets, stopped = {}, set()
    total = share * sum(sizes)
    while True:
        free = [k for k in range(len(sizes)) if k not in stopped]
        left = total - sum(2 * sizes[k] for k in stopped)
        over = [k for k in free if left * weights[k] / sum(weights[j] for j in free) > 2 * sizes[k]]
        if not over:
            break
        stopped |= set(over)
    for k in range(len(sizes)):
        targets[k] = 2 * sizes[k] if k in stopped else left * weights[k] / sum(weights[j] for j in free)
    return targets


def test_mixing_meets_targets(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["b", "a", "Z", "é", None, "hot", "hot", "hot"]), rng.choice([0, 1, 3, 50, 400, 9000])) for i in range(900)]
    rows += [(None, "a", 7), (5, "a", 9), (5, "a", 9), (6, "none", None), (7, "zero", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long").selectExpr("*", "'x' as taken", "1 as bucket")
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size or 0
    order = sorted((s for s in sizes if s is not None), key=str) + [None]
    targets = water_filled([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 1.5)
    taken = defaultdict(int)
    for row in found:
        assert 0 <= row.taken <= 2 * row.size and row.source_size == sizes[row.source]
        assert row.target == pytest.approx(targets[order.index(row.source)])
        assert row.copies in (0, 1, 2) and abs(row.copies * row.size - row.taken) <= row.size
        taken[row.source] += row.taken
    for k, source in enumerate(order):
        assert abs(taken[source] - targets[k]) <= 0.5
    again = mixing.mix(docs).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_mixing_with_base_rates(spark):
    rows = [(i, "ab"[i % 2], 10 + i % 7, [None, 0.2, 1.0, 1.9, 5.0, -1.0][i % 6]) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, base double")
    found = mixing.mix(docs, base_col="base").collect()
    taken, target, rates = defaultdict(int), {}, defaultdict(set)
    for row in found:
        taken[row.source] += row.taken
        target[row.source] = row.target
        rates[row.source, row.base].add(round(row.rate, 9))
    for source in "ab":
        assert abs(taken[source] - target[source]) <= 0.5
        by_base = [min(rates[source, base]) for base in (0.2, 1.0, 1.9) if (source, base) in rates]
        assert by_base == sorted(by_base)
    assert all(len(r) == 1 for r in rates.values())


def test_mixing_of_nothing(spark, make_docs):
    empty = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix(empty).collect() == []
    blank = make_docs([(1, None, None), (2, "", "a")]).withColumn("size", F.lit(0).cast("long"))
    assert [(r.taken, r.target) for r in mixing.mix(blank).collect()] == [(0, 0.0), (0, 0.0)]


# Quality


def test_quality_on_held_out_rows(spark):
    found = {r.doc_id: r for r in queries.op7_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    assert len(found) == 1000
    for i, row in found.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.7)
    held = [r for r in labels if found[r.doc_id].held_out]
    right = sum(found[r.doc_id].predicted == r.quality for r in held)
    assert len(held) > 50 and right / len(held) > 0.97
    assert all(found[r.doc_id].predicted for r in held if r.quality == 1)


def test_quality_scores_every_row(spark, odd, make_docs):
    weights = quality.train(odd.withColumn("label", F.when(F.col("doc_id") < 5, 1).when(F.col("doc_id") < 8, 0)))
    assert len(weights) == (1 << quality.BITS) + 1
    rows = quality.score(odd, weights).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    by_text = defaultdict(set)
    for row, (i, text, _) in zip(rows, ODD):
        assert row.doc_id == i
        by_text[text or ""].add(row.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert quality.keep_accepted(odd, weights).schema == odd.schema
    assert quality.keep_accepted(odd, weights).count() == sum(r.predicted for r in rows)
    none = quality.train(odd.withColumn("label", F.lit(None).cast("int")))
    assert not none.any() and {r.score for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.score(odd.limit(0), weights).collect() == []


def test_quality_training_is_repeatable_and_bounded(spark, sample):
    labelled = sample.withColumn("label", (F.col("doc_id") % 2).cast("int"))
    assert np.array_equal(quality.train(labelled), quality.train(labelled.repartition(5)))
    assert not np.array_equal(quality.train(labelled), quality.train(labelled, max_rows=50))


# Licences


def expected_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    base = sorted(
        (i, label)
        for phrase, label in licenses.BASE
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    found, share = set(), 0.0
    postings, votes = licenses.index()
    for n, (label, notice, phrases) in enumerate(licenses.NOTICES):
        notice = notice.split()
        for shift in range(-len(notice), len(words)):
            there = [0 <= shift + k < len(words) and words[shift + k] == w for k, w in enumerate(notice)]
            rare = sum(there[k] for w, places in postings.items() for m, k in places if m == n)
            keys = [next(k for k in range(len(notice)) if notice[k : k + len(p.split())] == p.split()) for p in phrases]
            if rare >= votes[n] and all(all(there[k : k + len(p.split())]) for k, p in zip(keys, phrases)):
                found.add(label)
                share = max(share, sum(there) / len(notice))
    labels = {label for _, label in base}
    return (
        len(words),
        len(base),
        base[0][0] if base else None,
        base[-1][0] if base else None,
        ",".join(sorted(labels)),
        ",".join(sorted(labels | found)),
        1.0 if base else share,
    )


def test_license_scan(make_docs):
    texts = [t for _, t, _ in ODD] + [
        "MIT License",
        "mit  license MIT LICENSE. The Apache-License!",
        "Released under the MIT License. All rights reserved.",
        "x" * 50 + " Licensed under CC BY-NC 4.0, and more",
        "licensed under CC BY NC 4 0 licensed under cc by nc 4 0",
        "GNU Lesser General Public License; under the terms of the GNU Lesser General Public License",
        "rights reserved", "all rights", "mitÉ license", "MİT license", "general public\nlicense", "license mit general public",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "hereby granted free of charge associated documentation files",
        "all rights reserved " * 5_000,
    ]
    rows = [(i, text, "s") for i, text in enumerate(texts)]
    found = licenses.scan(make_docs(rows)).orderBy("doc_id").drop("notices").collect()
    for row, (i, text, _) in zip(found, rows):
        if len(text or "") < 5_000:
            assert tuple(row) == (i, *expected_scan(text)), text
    assert found[-1].labels == "proprietary" and found[-1].n_words == 15_000


def test_a_key_phrase_alone_makes_a_label(make_docs):
    texts = ["Mozilla Public License 1.1", "under the Mozilla Public License."]
    texts += [" ".join(phrases) for _, _, phrases in licenses.NOTICES if len(phrases) == 1]
    labels = ["mpl", "mpl"] + [label for label, _, phrases in licenses.NOTICES if len(phrases) == 1]
    found = licenses.scan(make_docs([(i, text, "s") for i, text in enumerate(texts)])).orderBy("doc_id").collect()
    for row, label, text in zip(found, labels, texts):
        assert label in row.labels.split(","), text
        assert tuple(row)[:-1] == (row.doc_id, *expected_scan(text))


def test_license_scan_shuffles_nothing(sample):
    plan = licenses.scan(sample)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert licenses.scan(sample.limit(0)).collect() == []


# URL filters


def expected_rule(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = lower(host)
    fits = [
        (rule, verdict)
        for rule, verdict in url_filters.RULES
        if (host == rule.split("/", 1)[0] or host.endswith("." + rule.split("/", 1)[0]))
        and path.startswith("/" + rule.split("/", 1)[1])
    ]
    return host, path, *max(fits, key=lambda r: len(r[0]), default=(None, None))


URLS = [
    None, "", "no scheme", "http://", "http:///x", "://", "http://a.net", "http://a.net/", "http://NET/x", "http://xnet/",
    "https://example.net/en/1", "https://m.Example.NET/en/1?x=://y", "https://example.net/en", "http://badexample.net/en/",
    "http://example.com/de/x#y", "http://www.example.com/de", "http://a.org/fr/", "http://a.org/fr?x", "http://a.org:80/fr/",
    "http://a.org#/fr/", "http://ü.org/fr/ü\n/x", "a\nb://c.net/\nd", "http://x.com/y://z.net/", "http://example.com/DE/x",
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, host string")
    found = url_filters.judge(pages, url_filters.TokenRules(())).orderBy("page_id").collect()
    for row, url in zip(found, URLS):
        host, path, rule, verdict = expected_rule(url)
        assert tuple(row)[1:] == (host, path, rule, verdict or "allow"), url
    assert url_filters.judge(pages.limit(0), url_filters.TokenRules(())).collect() == []


def test_mined_rules_are_the_frequent_and_confident_ones(spark):
    rng = random.Random(1)
    urls = []
    for i in range(1500):
        words = [rng.choice(["casino", "news", "blog"]), rng.choice(["win", "read"]), rng.choice(["a", "b", "c"])]
        bad = words[:2] == ["casino", "win"] and rng.random() < 0.95 or rng.random() < 0.05
        urls.append((f"http://{words[0]}.example.org/{words[1]}/{words[2]}/{i}", bad if i % 10 else None))
    frame = spark.createDataFrame(urls, "url string, bad boolean")
    mined = url_filters.mine(frame, min_support=0.01, min_confidence=0.7)
    labelled = frame.where("bad is not null").select(url_filters.tokens_of(F.col("url")).alias("t"), "bad").collect()

    def measures(tokens):
        holding = [r.bad for r in labelled if set(tokens) <= set(r.t)]
        return sum(holding) / len(labelled), sum(holding) / len(holding)

    assert mined.sets
    for tokens in mined.sets:
        support, confidence = measures(tokens)
        assert support >= 0.01 and confidence >= 0.7
        assert not any(set(other) < set(tokens) for other in mined.sets)
    assert any(set(s) == {"host=casino", "path=win"} for s in mined.sets)
    pages = frame.selectExpr("url", "cast(null as long) as page_id")
    verdicts = url_filters.judge(pages, mined).select("host", "path", "verdict").collect()
    for row in verdicts:
        assert (row.verdict == "block") == (row.host.startswith("casino") and row.path.startswith("/win"))
    assert url_filters.mine(frame.limit(0)).sets == ()


def test_url_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in queries.op5_url_filter(spark, SF).collect():
        host, path, rule, verdict = expected_rule(pages[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if rule else row.verdict in ("allow", "block")


def test_equal_base_rates_are_reached_by_newton_steps(make_docs, monkeypatch):
    """The dual is solved from multipliers of 0; the closed form of equal base rates is only what it must come to."""
    steps = []
    real = mixing.written
    monkeypatch.setattr(mixing, "written", lambda df, name: (steps.append(name), real(df, name))[1])
    docs = make_docs([(i, "x", "ab"[i % 5 == 0]) for i in range(500)]).withColumn("size", F.col("doc_id") % 37)
    rates = {r.source: (r.rate, r.target / r.source_size) for r in mixing.mix(docs).collect()}
    assert steps.count("mix-dual") > 3
    for rate, wanted in rates.values():
        assert rate == pytest.approx(wanted, rel=1e-9)


def test_url_rules_are_those_of_brute_force(spark):
    """All sets of tokens with enough bad pages and confidence, of which no part is one, on pages with odd URLs among them."""
    rng = random.Random(12)
    words = ["win", "bets", "news", "shop", "blog", "a"]
    rows = [(None, True), ("", False), ("no scheme", True), ("http://", False), ("x://y/" + "long/" * 5000, True)]
    for _ in range(260):
        url = f"http://{rng.choice(words)}.example.com/{rng.choice(words)}/{rng.choice(words)}?q={rng.randrange(9)}"
        rows += [(url, rng.random() < (0.9 if "win" in url else 0.3))] * rng.choice([1, 1, 2])
    frame = spark.createDataFrame([(*r, "x") for r in rows], "url string, bad boolean, tokens string")
    mined = url_filters.mine(frame, min_confidence=0.6, min_pages=12)
    given = [(frozenset(r.t), r.bad) for r in frame.select(url_filters.tokens_of(F.col("url")).alias("t"), "bad").collect()]
    bad = [tokens for tokens, is_bad in given if is_bad]
    # Of tokens that the same bad pages hold the rarest stands for all.
    by_pages = defaultdict(list)
    for token in set().union(*bad):
        by_pages[tuple(i for i, t in enumerate(bad) if token in t)].append(token)
    rarest = lambda tokens: min(tokens, key=lambda x: (sum(x in t for t, _ in given), x))
    units = {frozenset([rarest(tokens)]) for pages, tokens in by_pages.items() if len(pages) >= 12}
    sets, front = set(), set(units)
    while front:
        sets |= front
        front = {a | b for a in front for b in units if sum((a | b) <= t for t in bad) >= 12} - sets
    passed = {s for s in sets if sum(s <= t for t in bad) >= 0.6 * sum(s <= t for t, _ in given)}
    expected = {s for s in passed if not any(other < s for other in passed)}
    assert expected and {frozenset(s) for s in mined.sets} == expected


def test_url_rules_of_deep_paths(spark):
    """Tokens that always come together do not double the combinations."""
    deep = "/".join(f"part{chr(97 + i)}" for i in range(14))
    rows = [(f"http://casino.example.com/{deep}/{i}", True) for i in range(60)]
    rows += [(f"http://news.example.com/{deep[:20]}/{i}", False) for i in range(60)]
    mined = url_filters.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    assert mined.sets == (("host=casino",),)
    # Twenty bad pages make a rule in a table of any size.
    many = spark.createDataFrame(rows[:20], "url string, bad boolean").union(
        spark.range(30_000).selectExpr("concat('http://ok', id % 50, '.example.com/', id)", "false")
    )
    assert url_filters.mine(many).sets == (("host=casino",),)



# Fingerprints


def expected_edits(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    found = []
    for k, (i, text, _) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        found.append((i, len(text), text[: len(text) - quarter] + after[:quarter]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("per_range", [256, 2])
def test_fingerprints(odd, monkeypatch, per_range):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", per_range)
    rows = fingerprints.fingerprint(odd).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited) for r in rows), key=repr) == expected_edits(ODD)
    for row in rows:
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert len(row.fingerprint) in (0, fingerprints.ENTRIES * fingerprints.BITS // 4)
        assert (row.fingerprint == row.edited_fingerprint) == (row.near_edited == 1.0)
    assert fingerprints.fingerprint(odd.limit(0)).collect() == []


def test_fingerprints_without_ids(make_docs):
    rows = [(None, "some text here", "s"), (None, "another text", "s"), (None, None, "s")]
    found = fingerprints.fingerprint(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited) for r in found), key=repr) == expected_edits(rows)


def test_fingerprints_follow_order_and_distance(spark, make_docs):
    rng = random.Random(9)
    base = [rng.choice("abcdef") * rng.randint(1, 5) + str(rng.randint(0, 999)) for _ in range(400)]
    one, many = base.copy(), base.copy()
    for k in range(20, 400, 100):
        one[k] = "changed"
    for k in range(0, 400, 10):
        many[k] = "changed"
    moved = base[200:] + base[:200]
    texts = [base, base, one, many, moved, rng.sample(base, 400), ["of"] * 500, ["of"] * 499]
    docs = make_docs([(i, " ".join(t), "s") for i, t in enumerate(texts)], clashes=False)
    rows = docs.select("doc_id", fingerprints.signature(F.col("text")).alias("s")).orderBy("doc_id").collect()
    like = [sum(a == b for a, b in zip(rows[0].s, r.s)) / fingerprints.ENTRIES for r in rows]
    assert like[1] == 1 and like[0] > like[2] > like[3] > 0.1
    assert like[4] < like[2] and like[5] < 0.1
    repeated = sum(a == b for a, b in zip(rows[6].s, rows[7].s)) / fingerprints.ENTRIES
    assert 0.8 < repeated  # occurrences count: one of 500 is missing


def reference_signature(spark, text):
    """The signature by its definition, with Spark's hash of the elements."""
    found = re.findall(r"[^\x20\x09-\x0D]{1,12}", text)
    kmers = [found[i : i + 3] for i in range(max(1, len(found) - 2))]
    seen, rows = defaultdict(int), []
    for at, kmer in enumerate(kmers):
        rows.append((at, *(kmer + [None] * 3)[:3], seen[tuple(kmer)]))
        seen[tuple(kmer)] += 1
    frame = spark.createDataFrame(rows, "at int, a string, b string, c string, nth int")
    upper = f"& {-1 << fingerprints.PLACE_BITS}"
    kmer = f"(xxhash64(a, b, c) {upper})"
    hashed = frame.selectExpr(f"if(nth = 0, {kmer}, xxhash64({kmer}, nth) {upper}) as h", "at")
    elements = sorted((r.h, r.at) for r in hashed.collect())
    pairs = []
    for k in range(fingerprints.ENTRIES):
        point = -(1 << 63) + k * ((1 << 64) // fingerprints.ENTRIES)
        first = sum(h < point for h, _ in elements)
        pairs.append(sorted((elements[(first + j) % len(elements)] for j in range(2)), key=lambda e: e[1]))
    frame = spark.createDataFrame([(k, a[0], b[0]) for k, (a, b) in enumerate(pairs)], "k int, a long, b long")
    return [r.x for r in frame.selectExpr("k", "cast(xxhash64(a, b) & 65535 as int) as x").orderBy("k").collect()]


@pytest.mark.parametrize("text", ["one", "a b", "of of of of of the of the of the", "x" * 40 + " some longer text, in which of of of repeats"])
def test_signature_by_definition(spark, make_docs, text):
    row = make_docs([(1, text, "s")]).select(fingerprints.signature(F.col("text")).alias("s")).first()
    assert row.s == reference_signature(spark, text)


def test_fingerprint_query_is_native(spark, sample):
    found = queries.op8_document_fingerprints(spark, SF)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    texts = {r.doc_id: r.text for r in sample.collect()}
    expected = {i: edited for i, _, edited in expected_edits([(i, t, None) for i, t in texts.items()])}
    rows = found.collect()
    assert all(hashlib.sha256(expected[r.doc_id].encode()).hexdigest() == r.edited_sha256 for r in rows)
    assert len({(texts[r.doc_id], r.fingerprint) for r in rows}) == len({*texts.values()})


# Pipeline


def test_pipeline_stages(spark, tmp_path, sample):
    docs, kept = sample, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        kept[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = kept[name][1]
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert kept[name][1].schema == sample.schema

    before, after = kept[names[0]]
    scored = quality.score(before, queries.train_quality(spark, before, SF)).where("predicted = 1")
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in scored.collect())

    before, after = kept[names[1]]
    wanted = exact_dedup.exact_dedup(before).where("kept")
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in wanted.collect())

    before, after = kept[names[2]]
    wanted = near_dedup.near_dedup(before, words=5, percent=80).where("kept")
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in wanted.collect())

    before, after = kept[names[3]]
    sized = before.withColumn("size", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long"))
    wanted = [r.doc_id for r in mixing.mix(sized).collect() for _ in range(r.copies)]
    assert sorted(r.doc_id for r in after.collect()) == sorted(wanted)

    before, after = kept[names[4]]
    assert after.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    check_places([(r.sequence_id, r.offset, r.length) for r in after.collect()], 2048)
    run = corpus_pipeline.run(spark, SF)
    assert run.agg(F.sum("length"), F.count("*")).first() == after.agg(F.sum("length"), F.count("*")).first()


def test_pipeline_stages_take_odd_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0, name
        found = stage(spark, odd, SF)
        assert found.count() > 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found.columns == odd.columns, name
