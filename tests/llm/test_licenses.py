import math
import random
import re

import pytest

from brinefold.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return [w.encode() for w in WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]


def brute_blocks(words, t):
    found = []
    for start in range(max(1, len(words) - t.window + 1)):
        block = words[start : start + t.window]
        shared = len(set(block) & set(t.words))
        if block and shared >= (len(set(t.words)) if t.phrase else math.ceil(t.threshold * len(set(t.words)) - 1e-9)) and (not t.phrase or tuple(block) == t.words):
            found.append((start, shared / len(set(t.words))))
    return found


@pytest.mark.parametrize("seed", range(6))
def test_blocks_equal_brute_force(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)]
    known = licenses.templates({"w1 w2 w1": "p", "w3": "q"}, [("1", "a", " ".join(rng.choices(vocabulary, k=12))), ("2", "b", " ".join(vocabulary[:20]))], rng.choice([0.5, 0.8, 1.0]))
    for _ in range(60):
        words = [w.encode() for w in rng.choices(vocabulary, k=rng.choice([0, 2, 10, 60]))]
        frequency = {w.encode(): rng.randint(0, 50) for w in vocabulary}
        for t in known:
            assert sorted(licenses.blocks(words, t, t.ranks(frequency))) == brute_blocks(words, t)


TEXTS = [
    "Released under the MIT License.", "under the mit license under the MIT\nlicense", "Licensed under the Apache License, Version 2.0.", "CC BY-NC", "cc  by\t\tnc cc by", "undér the mit license", "under the mit licenses", None, "", "...",
    "This work is licensed under the GNU General Public License, version 3.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and accompanying files", "x " * 50_000 + "under the mit license", "ĀUNDER THE MIT LICENSE",
]


def test_scan(spark):
    rows = [(i, t, "clash", 1.0) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "clash", 1.0), (None, TEXTS[1], "clash", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, score double")
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows)
    want = []
    for i, t, _, _ in rows:
        words = brute_words(t)
        places = [(n, label) for phrase, label in licenses.PHRASES.items() for n in range(len(words)) if words[n : n + len(phrase.split())] == [w.encode() for w in phrase.split()]]
        all_blocks = [(x.label, s) for x in licenses.templates() for _, s in brute_blocks(words, x)]
        starts = [n for n, _ in places]
        want.append((i, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})), ",".join(sorted({x for x, _ in all_blocks})), max([0.0, *(s for _, s in all_blocks)])))
    assert sorted(map(repr, [tuple(r) for r in got])) == sorted(map(repr, want))
    by = {r.id: r for r in got if r.id is not None}
    assert by[1].n_base == 2 and by[1].first_word == 0 and by[1].last_word == 4
    assert by[10].labels == "gpl-3" and by[11].labels == "mit" and 0.8 <= by[11].score < 1 and by[5].n_base == 0
    assert licenses.scan(docs.limit(0)).count() == 0


def test_templates_need_words():
    with pytest.raises(ValueError):
        licenses.templates({"...": "x"}, {})


def test_whole_notices_and_a_table_of_templates(spark):
    rng = random.Random(1)
    rows = []
    for n, (_, label, text) in enumerate(licenses.NOTICES):
        words = text.split()
        for at in rng.sample(range(len(words)), len(words) // 20):  # one word of twenty is another
            words[at] = "reworded"
        rows.append((n, "some words before " + " ".join(words) + " and some after", label))
    rows.append((99, "the software is provided to any person in binary form and nobody is liable for the use of this software", ""))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    got = {r.id: r.labels.split(",") for r in licenses.scan(docs).collect()}
    assert all(label in got[n] for n, _, label in rows) and got[99] == [""]
    table = spark.createDataFrame([(7, "own", "every copy of this text shall name its author and the year")], "id long, label string, text string")
    own = spark.createDataFrame([(1, "Every copy of this work shall name its author, and the year!"), (2, rows[0][1])], "doc_id long, text string")
    assert {r.id: r.labels for r in licenses.scan(own, table=table).collect()} == {1: "own", 2: ""}
