"""SimHash operators against brute force, and their defined results."""

import os
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from brinefold.llm import simhash
from brinefold.llm.common import connected_components


def brute_fingerprint(text, words=3):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i : i + words]), seed=42) for i in range(max(1, len(tokens) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, near):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog again and again"),
    (2, "The QUICK brown fox jumps\tover the lazy dog again and again"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one"),
    (7, "one two"),
    (8, "ÀÉ one two three"),
    (9, "àé one two three"),
    (10, "word " * 70_000),
    (11, "a b c a b c a b c"),
    (12, "the quick brown fox jumps over the lazy dog again and again"),
    (12, "the quick brown fox jumps over the lazy dog again and again"),
    (None, "the quick brown fox jumps over the lazy dog again and again"),
    (13, "x y z w"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", 0, "clash") for i, t in TEXTS], "doc_id long, text string, id string, fp int, component_id string")


def test_fingerprints_equal_brute_force(docs):
    got = {(r.id, r.fp & (2**64 - 1)) for r in simhash.fingerprints(docs).collect()}
    assert got == {(i, brute_fingerprint(t)) for i, t in TEXTS}


def test_near_duplicates_on_edge_cases(docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    marks = {i: brute_fingerprint(t) for i, t in TEXTS if i is not None}
    roots = brute_components(sorted(marks), lambda a, b: bin(marks[a] ^ marks[b]).count("1") <= 2)
    assert {(r.id, r.component_id) for r in rows if r.id is not None} == set(roots.items())
    assert [r.component_id for r in rows if r.id is None] == [roots[1]]
    assert roots[3] == roots[4] == roots[5] == 3


def test_empty_table(docs):
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.deduplicate(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed,budget,cap", [(0, 2, 16_384), (1, 2, 3), (2, 5, 4), (3, 0, 2)])
def test_trie_links_connect_what_brute_force_connects(spark, seed, budget, cap):
    rng = random.Random(seed)
    keys = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(12):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            keys.add(x)
    rows = list(enumerate(sorted(keys)))
    signed = [(i, k - 2**64 if k >= 2**63 else k) for i, k in rows]
    links = simhash.trie_links(spark.createDataFrame(signed, "id long, fp long"), budget, unit_cap=cap)
    found = {i: i for i, _ in rows} | {r.node: r.root for r in connected_components(links).collect()}
    keys = dict(rows)
    assert found == brute_components(list(keys), lambda a, b: bin(keys[a] ^ keys[b]).count("1") <= budget)


@pytest.mark.parametrize("budget", [0, 1, 2, 4])
def test_trie_pairs_are_all_pairs_within_the_budget(budget):
    rng = np.random.default_rng(budget)
    keys = np.unique((rng.integers(0, 1 << 10, 300) << 50).astype(np.uint64) | rng.integers(0, 16, 300).astype(np.uint64))
    got = {tuple(sorted(p)) for p in simhash.trie_pairs(keys, np.array([0, len(keys)]), budget).tolist()}
    assert got == {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if bin(int(keys[i] ^ keys[j])).count("1") <= budget}


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (301, 300), (300, 301)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 150)} | {300: 300, 301: 300}


def jaccard(a, b, words=5):
    sets = []
    for t in (a, b):
        w = t.lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_deduplicate_keeps_one_of_each_group_and_clean_documents(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.sample(words, 40)
    rows, groups = [], []
    for g in range(30):
        base = rng.sample(words, 200) + (passage if g % 3 == 0 else [])
        own = []
        for c in range(rng.choice([1, 2, 6])):
            text = list(base)
            for at in rng.sample(range(len(text)), 2 * min(c, 1)):
                text[at] = rng.choice(words)
            rows.append((len(rows), " ".join(text)))
            own.append(rows[-1][0])
        groups.append(own)
    texts = dict(rows)
    assert all(jaccard(texts[own[0]], texts[i]) >= 0.8 for own in groups for i in own)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, anchors string")
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [own[0] for own in groups]


def kept_of(spark, texts):
    return sorted(r.doc_id for r in simhash.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())


def test_texts_of_equal_fingerprints_are_compared(spark):
    texts = [" ".join([f"{k}{i}" for i in range(60)] + ["-"] * 200) for k in "ab"]
    assert jaccard(*texts) < 0.1
    assert kept_of(spark, texts) == [0, 1]


def test_repeated_lines_and_short_texts_lose_no_link(spark):
    line = " ".join(f"l{i}" for i in range(9))
    long = " ".join(f"t{i}" for i in range(300))
    short = [" ".join(f"s{k}x{i}" for i in range(8 + more)) for k in range(40) for more in (0, 1)]
    texts = [f"{long} {line}", f"{long} " + f"{line} " * 20, *short]
    assert jaccard(*texts[:2]) >= 0.8 and jaccard(*short[:2]) >= 0.8
    assert kept_of(spark, texts) == list(range(0, len(texts), 2))


def test_a_common_passage_loses_no_link(spark):
    rng, passage, texts = random.Random(9), [f"p{i}" for i in range(100)], []
    for d in range(150):
        own = [f"d{d}x{i}" for i in range(40)]
        again = list(own)
        again[rng.randrange(40)] = "edit"
        texts += [" ".join(own + passage), " ".join(again + passage)]
    near = [jaccard(*texts[i : i + 2]) >= 0.8 for i in range(0, 300, 2)]
    assert kept_of(spark, texts) == sorted([*range(0, 300, 2), *[2 * i + 1 for i, n in enumerate(near) if not n]])


def test_copies_of_copies_stay_linked(spark):
    rng, texts, chains = random.Random(11), [], []
    for g in range(40):
        hub = [f"g{g}w{i}" for i in range(200)]
        places = rng.sample(range(0, 200, 5), 8)
        edited = lambda at: " ".join("edit" if i in at else w for i, w in enumerate(hub))  # noqa: E731, B023
        chains.append(len(texts))
        texts += [edited(places[:4]), edited(places)]
        texts += [" ".join(hub)] + [edited(rng.sample(range(200), 1)) for _ in range(40)]
    assert all(jaccard(texts[i], texts[i + 1]) >= 0.8 > jaccard(texts[i + 1], texts[i + 2]) for i in chains)
    assert kept_of(spark, texts) == chains


def test_deduplicate_edge_cases(docs):
    kept = [r.doc_id for r in simhash.deduplicate(docs).select("doc_id").collect()]
    assert sorted(i for i in kept if i is not None) == [1, 3, 6, 7, 8, 9, 10, 11, 13]
    assert kept.count(None) == 1


def test_repeated_ids_leave_one_row(spark):
    docs = spark.createDataFrame([(7, "a b c d e f g h")] * 3 + [(8, "completely other words here in this one text")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.deduplicate(docs).collect()) == [7, 8]


def test_rows_and_not_ids_are_judged(spark):
    texts = [" ".join(f"{k}{i}" for i in range(30)) for k in "abc"]
    rows = [("x", texts[0], 1), ("x", texts[1], 2), ("y", texts[0], 3), ("z", texts[2], 4), ("z", texts[2], 5), (None, texts[2], 6)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n int").withColumn("m", F.create_map("n", "n"))
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id or "", r.text) for r in kept.collect())
    assert got == sorted([("x", texts[0]), ("x", texts[1]), ("z", texts[2]), ("", texts[2])])
    found = {(r.id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {("y", "x"), ("z", "z"), (None, "z")} <= found


def test_recall_by_similarity(spark):
    """Pairs of 0.8 and more are all linked, in every band; pairs below are not."""
    rng, texts, bands = random.Random(2), [], {}
    for g in range(160):
        words = [f"g{g}w{i}" for i in range(rng.choice([30, 100, 300]))]
        again = list(words)
        for at in rng.sample(range(len(words)), rng.randint(1, max(1, len(words) // 25))):
            again[at] = "edit"
        own = jaccard(" ".join(words), " ".join(again))
        bands.setdefault(0 if own < 0.8 else 1 if own < 0.85 else 2 if own < 0.9 else 3, []).append(len(texts))
        texts += [" ".join(words), " ".join(again)]
    assert all(len(bands.get(b, [])) >= 5 for b in range(4)), {b: len(x) for b, x in bands.items()}
    kept = set(kept_of(spark, texts))
    assert {b: sum(i + 1 not in kept for i in own) / len(own) for b, own in bands.items()} == {0: 0, 1: 1, 2: 1, 3: 1}


def compared(monkeypatch):
    """What each call of ``alike`` is given from here on."""
    calls, real = [], simhash.alike

    def alike_(links, *rest):
        calls.append({(r.a, r.b) for r in links.select("a", "b").distinct().collect()})
        return real(links, *rest)

    monkeypatch.setattr(simhash, "alike", alike_)
    return calls


def edited(words, at):
    return " ".join("edit" if i in at else w for i, w in enumerate(words))


def test_deduplicate_begins_with_the_trie_join(spark, monkeypatch):
    rng, texts = random.Random(3), []
    for g in range(8):
        words = [f"g{g}w{i}" for i in range(400)]
        texts += [" ".join(words)] + [edited(words, [rng.randrange(400)]) for _ in range(5)]
    texts += [" ".join([f"{k}{i}" for i in range(60)] + ["-"] * 200) for k in "ab"]
    sets = [simhash.shingle_set(t.encode(), 5) for t in texts]
    marks = [simhash.majority([own]) for own in sets]
    docs = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "id long, text binary")
    nodes = spark.createDataFrame(list(enumerate(marks)), "id long, fp long")
    calls = compared(monkeypatch)
    found = {tuple(sorted((r.a, r.b))) for r in simhash.fingerprint_links(nodes, docs, 5, 0.8).collect()}
    apart = lambda a, b: bin((marks[a] ^ marks[b]) & (2**64 - 1)).count("1")
    assert all(apart(a, b) <= simhash.BUDGET for a, b in calls[0])
    assert len(found) >= 8 and all(jaccard(texts[a], texts[b]) >= 0.8 for a, b in found)
    roots = brute_components(range(len(texts)), lambda a, b: (a, b) in found)
    assert kept_of(spark, texts) == [*range(0, 48, 6), 48, 49]
    numbers = {r.id: r.doc_id for r in spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", F.xxhash64(F.lit(0), F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"))).alias("id")).collect()}
    last = {(numbers[a], numbers[b]) for a, b in calls[-1]}
    assert not [(a, b) for a, b in last if roots[a] == roots[b]], "what the trie connected is not compared again"


def test_a_fringe_of_less_alike_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    rng, words = random.Random(8), [f"w{i}" for i in range(100)]
    some = lambda n: rng.sample(range(5, 95, 5), n)
    texts = [" ".join(words)] + [" ".join(f"x{d}" if i in at else w for i, w in enumerate(words)) for d in range(160) for at in [some(2 if d % 2 else 3)]]
    calls = compared(monkeypatch)
    near = {(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8}
    roots = brute_components(range(len(texts)), lambda a, b: (b, a) in near)
    assert kept_of(spark, texts) == sorted(set(roots.values()))
    assert sum(map(len, calls)) <= len(near) + 6 * len(texts)


def test_deduplicate_keeps_no_tables_of_former_steps(spark, monkeypatch):
    """On some GB, crowds with a sketch in each row, kept from round to round, took most of the disk (6.07 of 6.55 GB at the peak of 2.08 GB)."""
    from brinefold.llm import common

    written, real, key = [], common.materialise, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    there = lambda: [label for label, table, _ in written if os.path.isdir(table.written_to.removeprefix("file://"))]
    most = {}

    def write(df, label):
        made = real(df, label)
        written.append((label, made, spark.conf.get(key, None)))
        for name in {*there()}:
            most[name] = max(most.get(name, 0), there().count(name))
        return made

    for where in (simhash, common):
        monkeypatch.setattr(where, "materialise", write)
    rng, words = random.Random(8), [f"w{i}" for i in range(100)]
    texts = [" ".join(words)] + [edited(words, rng.sample(range(5, 95, 5), 6)) + f" own{d}" for d in range(120)]
    before = spark.conf.get(key, None)
    kept = kept_of(spark, texts)
    roots = brute_components(range(len(texts)), lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    assert kept == sorted(set(roots.values()))
    labels = [label for label, *_ in written]
    assert labels.count("crowds") > 2, labels
    assert {**most} | {"crowds": 2, "followers": 1, "compared": 1, "leaders": 1, "shingles": 1} == {**most}, most
    assert not {*there()} - {"alike", "cells", "gone", "hot-keys", "links", "unit-links"}, there()
    assert {label for label, table, _ in written if "sketch" in table.columns} == {"marks", "texts", "groups"}
    assert {(label == "gone", at) for label, _, at in written} == {(False, "true"), (True, before)}
    assert spark.conf.get(key, None) == before


def test_sketches_rule_out_no_pair_that_is_alike(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SKETCH_LONGS", 8)
    rng, sets, pairs, want = np.random.default_rng(6), [np.empty(0, dtype=np.uint64)] * 2, [(0, 1)], {(0, 1)}
    for n in [1, 5, 60, 64, 65, 70, 128, 129, 140, 500, 513, 3000]:
        for lost, more in [(0, 0), (n // 10, 0), (0, n // 4), (n // 5, 0), (n // 10, n // 10), (n // 2, n // 2), (n, n)]:
            one = rng.integers(0, 1 << 64, n, dtype=np.uint64)
            two = np.concatenate([one[lost:], rng.integers(0, 1 << 64, more, dtype=np.uint64)])
            sets += [one, two]
            pairs.append((len(sets) - 2, len(sets) - 1))
            if n - lost >= 0.8 * (n + more):
                want.add(pairs[-1])
    rows = [(i, len(own), i, simhash.parity_sketch(own).tolist()) for i, own in enumerate(sets)]
    known = spark.createDataFrame(rows, "id long, n int, root long, sketch array<long>")
    left = lambda k: {tuple(r) for r in simhash._possible(spark.createDataFrame(pairs, "a long, b long"), k, simhash._may_join(0.8)).collect()}
    got = left(known)
    assert want <= got
    assert not [(a, b) for a, b in got if 60 <= len(sets[a]) <= 500 and not np.intersect1d(sets[a], sets[b]).size]
    assert left(known.withColumn("root", F.lit(0))) == set()


def test_query_runs(spark):
    from brinefold.llm.queries import QUERIES

    got = QUERIES["op3_simhash"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = got.collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{brute_fingerprint(t):016x}" for i, t in texts.items()}
    marks = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    assert {r.doc_id: r.component_id for r in rows} == brute_components(sorted(marks), lambda a, b: bin(marks[a] ^ marks[b]).count("1") <= 2)
    assert got.where(F.length("fingerprint") != 16).count() == 0
