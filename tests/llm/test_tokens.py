import base64
import random
import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brinefold.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY, COUNTER = Tokenizer.from_file(PATH), tokens.PrefixCounter(PATH)


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_counts_of_any_text(text):
    assert COUNTER.prefixes(text).total == sum(COUNTER.counts(text)) == library(text)


@pytest.mark.parametrize("seed", range(40))
def test_every_prefix_and_truncation(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'re", "é", "漢", "😀", "<|endoftext|>", "12", ".", "\u2003", "ing"]) for _ in range(25))
    known = COUNTER.prefixes(text)
    exact = [library(text[:n]) for n in range(len(text) + 1)]
    assert [known.count(n) for n in range(len(text) + 1)] == exact
    for budget in (0, 1, 2, 5, 9, 50):
        assert known.truncate(budget) == max(n for n, c in enumerate(exact) if c <= budget)


def test_random_cuts():
    rng = random.Random(3)
    pieces = ["a", "the", " ", "  ", "\n", "'s", "'re", "'", "!!", "<|endoftext|>", "é", "中", "12", " word", "\t", "    ", "x'll", "---"]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        known, exact = COUNTER.prefixes(text), [library(text[:n]) for n in range(len(text) + 1)]
        for budget in (0, 1, 2, 3, 5, 8):
            assert known.truncate(budget) == max(n for n, c in enumerate(exact) if c <= budget)


@pytest.mark.parametrize("kind", ["letters", "han", "base64", "spaces", "dashes", "after"])
def test_long_words_take_linear_time(kind):
    rng = random.Random(4)
    letters = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=20_000))
    text = {
        "letters": letters,
        "han": "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(20_000)),
        "base64": "".join(c for c in base64.b64encode(rng.randbytes(750_000)).decode() if c.isalpha()),
        "spaces": " " * 20_000 + "<|endoftext|>x",
        "dashes": "-" * 200_000,
        "after": "some words before " * 100 + letters + "<|endoftext|>" * 600,
    }[kind]
    began = time.perf_counter()
    known = COUNTER.prefixes(text)
    cuts = {budget: known.truncate(budget) for budget in (1, 300, 512)}
    assert time.perf_counter() - began < 60
    assert known.total == library(text)
    for budget, cut in cuts.items():
        assert library(text[:cut]) <= budget < library(text[: cut + 1])


def test_window_of_states(monkeypatch):
    monkeypatch.setattr(tokens, "STATES", 10)
    word = "".join(random.Random(5).choices("abcdefgh", k=3000))
    assert tokens.PrefixCounter(PATH).prefixes(word).total == library(word)


def test_full_memos_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 5)
    own = tokens.PrefixCounter(PATH)
    text = "several words that fill the memo again and again, several words"
    assert own.prefixes(text).total == library(text)
    assert own.state(b"z" * 200)[0] == library("z" * 200)


def test_frames(spark):
    texts = ["", None, "a", "word " * 600, "<|endoftext|>" * 513, " " * 2000, "x" * 3000, "é" * 300, "word " * 30_000]
    rows = [(i, t, 1, "clash") for i, t in enumerate(texts)] + [(0, "again", 1, "clash"), (None, "null id", 1, "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, id string")
    got = sorted(((r.id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, PATH).collect()), key=repr)
    assert got == sorted(((i, len((t or "").encode()), library(t or ""), library(t or "") > 512) for i, t, _, _ in rows), key=repr)
    for r in tokens.count_tokens(docs, PATH).where("id < 7").collect():
        text = next(t for i, t, _, _ in rows if i == r.id) or ""
        if r.over_limit:
            assert library(text[: r.cut_chars]) <= 512 < library(text[: r.cut_chars + 1])
    assert tokens.count_tokens(docs.limit(0), PATH).count() == 0
