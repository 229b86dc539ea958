"""License scans: an exact set-similarity join of text blocks with license templates.

A block is any run of as many words as a template's window has; it meets a template if it holds at least
``THRESHOLD`` of the template's distinct words. Each template's words are put in order of their
frequency over all texts, rarest first. A block that meets the template must hold one of its first
``n - ceil(t n) + 1`` words (prefix filter), the text must have enough words (length filter), and a block
whose rarest shared word stands at place i can share no more than ``n - i`` words (positional filter).
Only windows around such words are counted, so nothing that meets the threshold is missed. A
``phrase`` is a template whose words must all be there, in their order and next to each other.

Defined results: a null, empty or wordless text has no words, labels or places, and score 0; labels and
places count once each however often a block is found; rows are scanned one by one, repeated ones too;
very long texts are scanned whole. Columns that are not named are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import private
from .notices import NOTICES

THRESHOLD = 0.8
#: Window of a template, in multiples of its words.
SLACK = 1.25

#: Phrases and their labels (fixed values).
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Templates that a table of them may have, and words of all: they go to every task.
MAX_TEMPLATES = 10_000
MAX_TEMPLATE_WORDS = 5_000_000

_SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
_TABLE = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters (A-Z lower-cased), digits and all bytes above ASCII."""
    return (text or b"").translate(_TABLE).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    phrase: bool
    threshold: float

    @property
    def distinct(self) -> frozenset[bytes]:
        return frozenset(self.words)

    @property
    def need(self) -> int:
        """Distinct words that a block must share."""
        return len(self.distinct) if self.phrase else math.ceil(self.threshold * len(self.distinct) - 1e-9)

    @property
    def window(self) -> int:
        return len(self.words) if self.phrase else math.ceil(SLACK * len(self.words))

    def ranks(self, frequency: dict[bytes, int]) -> dict[bytes, int]:
        """Places of the words when the rarest comes first."""
        return {w: i for i, w in enumerate(sorted(self.distinct, key=lambda w: (frequency.get(w, 0), w)))}

    def prefix(self, rank: dict[bytes, int]) -> frozenset[bytes]:
        """Words of which a block needs one: from a later place on, too few are left."""
        return frozenset(w for w, i in rank.items() if len(rank) - i >= self.need)


def templates(phrases: dict[str, str] | None = None, notices: Iterable[tuple[str, str, str]] | None = None, threshold: float = THRESHOLD) -> list[Template]:
    """Phrases by their labels, and notices as (id, label, text)."""
    made = [Template(label, tuple(words_of(p.encode())), True, 1.0) for p, label in (PHRASES if phrases is None else phrases).items()]
    made += [Template(label, tuple(words_of(p.encode())), False, threshold) for _, label, p in (NOTICES if notices is None else notices)]
    if not all(t.words for t in made):
        raise ValueError("a template needs a word")
    if len(made) > MAX_TEMPLATES or sum(len(t.words) for t in made) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"there may be {MAX_TEMPLATES} templates of {MAX_TEMPLATE_WORDS} words in all")
    return made


def notices_of(table: DataFrame) -> list[tuple[str, str, str]]:
    """Notices from a table of templates with ``id``, ``label`` and ``text``, of which at most ``MAX_TEMPLATES`` are taken."""
    rows = table.select("id", "label", "text").limit(MAX_TEMPLATES + 1).collect()
    if len(rows) > MAX_TEMPLATES:
        raise ValueError(f"there may be {MAX_TEMPLATES} templates")
    return sorted((str(r.id), r.label, r.text) for r in rows)


def blocks(words: list[bytes], template: Template, rank: dict[bytes, int]) -> Iterator[tuple[int, float]]:
    """(start, containment) of each block that meets the template. ``rank``: the place of each of its words in their order."""
    need, width = template.need, template.window
    if len(words) < need:
        return
    size, distinct = len(words), len(rank)
    last = max(0, size - width)
    spans: list[list[int]] = []
    for at, word in enumerate(words):
        if word in rank and distinct - rank[word] >= need:
            lo, hi = max(0, min(at - width + 1, last)), min(at, last)
            if spans and lo <= spans[-1][1] + 1:
                spans[-1][1] = max(spans[-1][1], hi)
            else:
                spans.append([lo, hi])
    for lo, hi in spans:
        inside = Counter(w for w in words[lo : lo + width] if w in rank)
        shared = len(inside)
        for start in range(lo, hi + 1):
            if start > lo:
                gone = words[start - 1]
                if gone in rank:
                    inside[gone] -= 1
                    shared -= not inside[gone]
                if start + width - 1 < size and (come := words[start + width - 1]) in rank:
                    inside[come] += 1
                    shared += inside[come] == 1
            if shared >= need and (not template.phrase or tuple(words[start : start + width]) == template.words):
                yield start, shared / distinct


def frequencies(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """Occurrences of each word of the vocabulary over all texts: a row for each word at most reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(filter(vocabulary.__contains__, words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    counted = private(docs, text=text_col).select(F.col("text").cast("binary")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in counted.collect()}


def scan(docs: DataFrame, *, table: DataFrame | None = None, threshold: float = THRESHOLD, known: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    The notices are those of ``table`` (``id``, ``label``, ``text``), or else the public ones of ``notices.py``.
    """
    if known is None:
        known = templates(notices=None if table is None else notices_of(table), threshold=threshold)
    frequency = frequencies(docs, set().union(*(t.distinct for t in known)), text_col)
    triggers = [(t, rank, t.prefix(rank)) for t in known for rank in [t.ranks(frequency)]]
    every = frozenset().union(*(p for *_, p in triggers))
    source = private(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("binary"))
    kinds = (("n_words", T.LongType(), pa.int64()), ("n_base", T.LongType(), pa.int64()), ("first_word", T.LongType(), pa.int64()), ("last_word", T.LongType(), pa.int64()), ("base_labels", T.StringType(), pa.string()), ("labels", T.StringType(), pa.string()), ("score", T.DoubleType(), pa.float64()))
    schema = T.StructType([source.schema["id"], *(T.StructField(n, t) for n, t, _ in kinds)])

    def one(text: bytes | None) -> tuple:
        words = words_of(text)
        if every.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0
        there, places, base, labels, score = every.intersection(words), set(), set(), set(), 0.0
        for template, rank, prefix in triggers:
            if prefix.isdisjoint(there):
                continue
            for start, contained in blocks(words, template, rank):
                score = max(score, contained)
                labels.add(template.label)
                if template.phrase:
                    places.add((start, template.words))
                    base.add(template.label)
        starts = [p for p, _ in places]
        return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(x.as_py()) for x in batch.column(1)]
            columns = [pa.array([f[i] for f in found], kind) for i, (_, _, kind) in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return source.mapInArrow(run, schema)
