"""Exact token counts at every prefix, by dynamic programming over prefixes.

Byte-pair encoding has a useful property: a sequence of tokens is the encoding of its text exactly if
each token encodes as itself and each two neighbours encode as those two. So the last token of a
prefix's encoding is the one vocabulary entry that ends there and fits after the last token of the
prefix before it, and a prefix's count is one more than that prefix's. The states of all prefixes of a
word are kept in a memo, which words with a common beginning share; the pair checks are kept too. A
text's count is the running sum over its words as the tokenizer splits them, and the sums are kept, so
that questions about truncation and budgets look counts up and never encode again. Words longer than
``LONG`` bytes are passed through by an automaton of all tokens, which keeps only a window of their states:
time is linear in a word's length, and memory is not bound to it.

Defined results: a null text is empty and has no tokens; special strings inside texts are single tokens,
as the library has it by default; texts of any length are taken whole; memos are emptied when they are
full, which costs time and changes nothing; repeated rows and ids are counted row by row.
"""

from __future__ import annotations

import json
from array import array
from bisect import bisect_right
from collections.abc import Collection, Iterator
from functools import cached_property, lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import private

LIMIT = 512
#: Entries of each memo before it is emptied.
MEMO = 400_000
#: Bytes of a word whose prefixes are kept in the memo.
LONG = 64
#: States of a long word that are kept before those out of any token's reach go.
STATES = 1 << 16
#: The byte-level pre-tokenizer's pattern (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: What follows the apostrophe in the pattern's contractions.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of the vocabulary file stands for: printable ones themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Memo(dict):
    """Count of a word, made at its first look-up."""

    def __init__(self, owner: PrefixCounter):
        super().__init__()
        self.owner = owner

    def __missing__(self, word: str) -> int:
        if len(word) > LONG:
            return 1 if word in self.owner.specials else self.owner.state(word.encode())[0]
        if len(self) >= MEMO:
            self.clear()
        # a special string is one token; no ordinary word is spelled like it
        n = self[word] = 1 if word in self.owner.specials else self.owner.state(word.encode())[0]
        return n


class PrefixCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        if model["model"]["type"] != "BPE" or model["pre_tokenizer"]["type"] != "ByteLevel" or model["normalizer"] is not None:
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        letters = _byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.ranks = {(raw(a), raw(b)): n for n, (a, b) in reversed(list(enumerate(merges)))}
        specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens = {raw(t) for t, i in model["model"]["vocab"].items() if t not in specials}
        self.longest = max(map(len, self.tokens))
        self.find = regex.compile(PATTERN).findall
        self.blank = regex.compile(r"\s+").fullmatch
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")") if specials else None
        self.specials = tuple(specials)
        self.memo = _Memo(self)
        self._states: dict[bytes, tuple[int, bytes]] = {}
        self._pairs: dict[tuple[bytes, bytes], bool] = {}

    def merge(self, data: bytes) -> list[bytes]:
        """Encoding by merges, as the vocabulary defines it; only for one or two tokens' bytes."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, before: bytes, token: bytes) -> bool:
        pair = (before, token)
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= MEMO:
                self._pairs.clear()
            known = self._pairs[pair] = self.merge(before + token) == ([before, token] if before else [token])
        return known

    def state(self, word: bytes) -> tuple[int, bytes]:
        """(tokens, last token) of a word. Of its first ``LONG`` bytes, only prefixes that are not in the memo are computed."""
        memo, short = self._states, word[:LONG]
        known = len(short)
        while known and short[:known] not in memo:
            known -= 1
        if known < len(short) and len(memo) + len(short) > MEMO:
            memo.clear()
            known = 0
        for end in range(known + 1, len(short) + 1):
            memo[short[:end]] = self._next(short, end, lambda start: memo[short[:start]] if start else (0, b""))
        if len(word) <= LONG:
            return memo[word] if word else (0, b"")
        for count, size in self.scan(word):
            pass
        return count, word[len(word) - size :]

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds the tokens that end at each place, the longest first."""
        made = ahocorasick.Automaton()
        for token in self.tokens:
            made.add_word(token.decode("latin-1"), token)
        made.make_automaton()
        return made

    def scan(self, word: bytes) -> Iterator[tuple[int, int]]:
        """(tokens, bytes of the last token) of each prefix of a word, one after another."""
        counts, sizes, base, done, pairs = array("q", [0]), array("l", [0]), 0, 0, self._pairs
        for at, token in self.automaton.iter(word.decode("latin-1")):
            if at < done:
                continue
            if at > done:
                break
            start = at + 1 - len(token)
            last = word[start - sizes[start - base] : start]
            fits = pairs.get((last, token))
            if fits or fits is None and self._fits(last, token):
                counts.append(counts[start - base] + 1)
                sizes.append(len(token))
                done = at + 1
                yield counts[-1], sizes[-1]
                if len(counts) > STATES + self.longest:
                    counts, sizes = counts[-self.longest - 1 :], sizes[-self.longest - 1 :]
                    base = done + 1 - len(counts)
        if done < len(word):
            raise ValueError("the vocabulary lacks a byte")

    def longest_prefix(self, word: str, room: int, but: Collection[int] = ()) -> int:
        """Characters of the longest prefix of a word with at most ``room`` tokens, those of ``but`` characters aside; 0 if none has."""
        if word in self.specials:
            return len(word) if room > 0 else 0
        data = word.encode()
        if len(data) <= LONG:
            self.state(data)
            counts = (self._states[data[:end]][0] for end in range(1, len(data) + 1))
        else:
            counts = (count for count, _ in self.scan(data))
        best = chars = 0
        for end, count in enumerate(counts, 1):
            if end > room * self.longest:  # no tokens so few reach so far
                break
            if end == len(data) or data[end] & 0xC0 != 0x80:  # a character ends here
                chars += 1
                if count <= room and chars not in but:
                    best = chars
        return best

    def _next(self, word: bytes, end: int, before) -> tuple[int, bytes]:
        """State of the prefix up to ``end``, from those of shorter ones."""
        tokens, pairs = self.tokens, self._pairs
        for start in range(max(0, end - self.longest), end):
            token = word[start:end]
            if token in tokens:
                count, last = before(start)
                fits = pairs.get((last, token))
                if fits or fits is None and self._fits(last, token):
                    return count + 1, token
        raise ValueError("the vocabulary lacks a byte")

    def split(self, text: str) -> list[str]:
        """Words as the tokenizer splits a text; special strings are words of their own."""
        if self.cut is None or not any(s in text for s in self.specials):
            return self.find(text)
        return [w for n, part in enumerate(self.cut.split(text)) for w in ([part] if n % 2 else self.find(part))]

    def counts(self, text: str) -> list[int]:
        """Tokens of each word of a text."""
        return list(map(self.memo.__getitem__, self.split(text)))

    def prefixes(self, text: str) -> PrefixCounts:
        return PrefixCounts(self, text)


class PrefixCounts:
    """Counts at every prefix of one text, without encoding it again."""

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.text = counter, text
        self.words = counter.split(text)
        self.sums = list(accumulate(map(counter.memo.__getitem__, self.words), initial=0))

    @property
    def total(self) -> int:
        return self.sums[-1]

    @cached_property
    def ends(self) -> list[int]:
        return list(accumulate(map(len, self.words), initial=0))

    def count(self, chars: int) -> int:
        """Tokens of the first ``chars`` characters, taken as a text of its own.

        Words that end before the prefix's last three are split the same in the prefix. The tail, whose
        split may differ (white space before a word, or a special string cut off), is split and looked up by itself.
        """
        chars = min(chars, len(self.text))
        k = bisect_right(self.ends, chars) - 1
        if self.ends[k] == chars and k == len(self.words):
            return self.sums[k]
        k = max(0, k - 2)
        return self.sums[k] + sum(self.counter.counts(self.text[self.ends[k] : chars]))

    def _odd(self, j: int) -> Collection[int]:
        """Lengths at which word ``j`` may be cut so that the tokenizer splits what is left in another way: a special string or a
        contraction cut off, or white space that joins the white space before it."""
        word, before = self.words[j], self.words[j - 1] if j else ""
        if word in self.counter.specials or word[0] == "'" and word[1:] in CONTRACTIONS:
            return range(1, len(word))
        if not before or not self.counter.blank(before):
            return ()
        return range(1, len(word) + 1) if self.counter.blank(word) else (1,) if word[0] == " " else ()

    def truncate(self, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens.

        Counts at the places of a word are its prefixes' states. Counts can fall as a word grows, so all of the word that meets the
        budget is looked through; at the few odd lengths, also of the two words after it, the tail is split anew.
        """
        if self.total <= budget:
            return len(self.text)
        k = bisect_right(self.sums, budget) - 1
        for j in range(min(k + 2, len(self.words) - 1), -1, -1):
            first, odd = self.ends[j], self._odd(j)
            best = self.counter.longest_prefix(self.words[j], budget - self.sums[j], odd) if j <= k else 0
            better = next((i for i in reversed(odd) if i > best and self.count(first + i) <= budget), best)
            if better:
                return first + better
        return 0


@lru_cache(maxsize=2)
def _counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str, *, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``cut_chars`` (longest prefix within the limit) of every row.

    ``tokenizer`` is the path of a vocabulary file that all executors have.
    """
    source = private(docs, id=id_col, text=text_col).select("id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kinds = (("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType()), ("cut_chars", T.LongType()))
    schema = T.StructType([source.schema["id"], *(T.StructField(n, t) for n, t in kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            sizes, totals, cuts = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                known = counter.prefixes(text)
                sizes.append(len(text.encode()))
                totals.append(known.total)
                cuts.append(known.truncate(limit))
            columns = [pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array([n > limit for n in totals], pa.bool_()), pa.array(cuts, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return source.mapInArrow(run, schema)
