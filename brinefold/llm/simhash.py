"""SimHash fingerprints, and near-duplicate links by a binary trie self-join.

The trie join follows pairs of trie nodes down together, adds up the bits in which their paths differ,
and leaves a pair as soon as that sum exceeds the error budget. It is dealt out over the cluster in
units: with a budget of k bits, two fingerprints agree on one of k + 1 blocks of bits. For each block the
fingerprint is rotated so that the block comes first, and the sub-trie below each block value is one
unit. A unit that holds too many fingerprints is replaced by the pairs of its sub-nodes that the budget
still allows, again and again, so that no task gets an unbounded group.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any other; a text of
fewer words than a shingle is one shingle; repeated shingles count each time; equal texts have equal
fingerprints; rows with a null id are kept as ids of their own value null; an empty table gives an empty
table. Other columns of the input are never looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from .common import MAX_BROADCAST_IDS, connected_components, discard, hashable, in_small_batches, lookup, materialise, private, with_row_key, without_rows, without_shuffle_files

BITS = 64
SEED = 42
#: Shingles that are hashed and summed at a time, whatever a text's length.
BLOCK = 1 << 15
#: Fingerprints in a unit before it is split further, and bits by which it is split.
UNIT_CAP = 16_384
SPLIT_BITS = 7
#: Fingerprints whose units are joined at a time in a task.
SLICE = 1 << 15
#: Of deduplication by similarity: words of a shingle, the Jaccard similarity of shingle sets, and the error budget of the trie join that comes first.
SHINGLE_WORDS = 5
SIMILARITY = 0.8
BUDGET = 3
#: Texts whose shingles are counted, and shingles kept, to know common ones. They decide an order only, never which pairs are found.
SAMPLE = 8192
COMMON = 200_000
#: Texts of a shingle above which leaders collapse its groups first, and rounds of leaders; what is left is compared pair by pair.
CROWD = 32
ROUNDS = 4
#: Texts of a side that are compared with one another in one cell.
CELL = 256
#: Most numbers of 64 bits in a parity sketch. Of larger sets it rules out less, and never a pair that is alike.
SKETCH_LONGS = 512
#: Room for rounding in comparisons of similarities.
SLACK = 1e-9


def shingle_hashes(text: bytes | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of ``words`` words, in blocks. Words are split at ASCII white space; A-Z are lower-cased."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        yield np.array([digest(joined, SEED)], dtype=np.uint64)
        return
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    for at in range(0, len(tokens) - words + 1, BLOCK):
        first = starts[at : min(at + BLOCK, len(tokens) - words + 1)].tolist()
        last = ends[at + words - 1 : at + words - 1 + len(first)].tolist()
        yield np.array([digest(joined[s:e], SEED) for s, e in zip(first, last)], dtype=np.uint64)


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """The fingerprint as a signed number of 64 bits."""
    return majority(shingle_hashes(text, words))


def majority(blocks: Iterable[np.ndarray]) -> int:
    """The bits that over half of the hashes have, as a signed number."""
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for hashes in blocks:
        total += len(hashes)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total).view(">u8").astype(np.uint64).view(np.int64)[0]) if total else 0


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``id`` and ``fp`` (a long)."""
    source = private(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("binary"))
    fields = [source.schema["id"], T.StructField("fp", T.LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(x.as_py(), words) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], names=[f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields))


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """The distinct shingle hashes in ascending order."""
    return np.unique(np.concatenate([np.empty(0, dtype=np.uint64), *shingle_hashes(text, words)]))


def parity_sketch(own: np.ndarray) -> np.ndarray:
    """For each of two to four times as many buckets as there are shingles whether their number in it is odd, as numbers of 64 bits.

    Each shingle that only one of two sets has changes one bucket, so their sketches differ in at most as many bits as the sets differ in shingles.
    """
    longs = min(SKETCH_LONGS, 1 << max(0, math.ceil(len(own) / 32) - 1).bit_length())
    odd = np.bincount((own & np.uint64(64 * longs - 1)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def trie_pairs(keys: np.ndarray, bounds: np.ndarray, budget: int, cross: np.ndarray | None = None) -> np.ndarray:
    """Index pairs of ``keys`` at most ``budget`` bits apart, within each unit ``bounds[u]:bounds[u + 1]``.

    Keys are unsigned, sorted and distinct within a unit. A trie node is a range of keys with a common
    prefix; the frontier is all pairs of nodes of one depth, whose differing bits are summed in ``err``.
    ``cross[u]`` above 0 is where a unit's second side begins: its keys are then sorted by side, and only pairs from side to side are sought.
    """
    a_lo, a_hi = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
    live = a_hi - a_lo > 1
    middle = np.zeros(len(a_lo), dtype=np.int64) if cross is None else cross.astype(np.int64)
    a_lo, a_hi, middle = a_lo[live], a_hi[live], middle[live]
    b_lo, b_hi, err = np.where(middle > 0, middle, a_lo), a_hi, np.zeros(len(a_lo), dtype=np.int64)
    a_hi = np.where(middle > 0, middle, a_hi)
    found = []
    for bit in range(BITS, -1, -1):
        if not len(a_lo):
            break
        if bit < BITS:
            ones = np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)])
            a_mid, b_mid = a_hi - (ones[a_hi] - ones[a_lo]), b_hi - (ones[b_hi] - ones[b_lo])
            same = a_lo == b_lo
            parts = [
                (a_lo, a_mid, b_lo, b_mid, err),
                (a_mid, a_hi, b_mid, b_hi, err),
                (a_lo, a_mid, b_mid, b_hi, err + 1),
                tuple(x[~same] for x in (a_mid, a_hi, b_lo, b_mid, err + 1)),
            ]
            a_lo, a_hi, b_lo, b_hi, err = (np.concatenate(x) for x in zip(*parts))
            live = (a_hi > a_lo) & (b_hi > b_lo) & (err <= budget) & ~((a_lo == b_lo) & (a_hi - a_lo == 1))
            a_lo, a_hi, b_lo, b_hi, err = a_lo[live], a_hi[live], b_lo[live], b_hi[live], err[live]
        leaf = (a_hi - a_lo == 1) & (b_hi - b_lo == 1)
        if leaf.any():
            x, y = a_lo[leaf], b_lo[leaf]
            near = np.bitwise_count(keys[x] ^ keys[y]) <= budget
            found.append(np.stack([x[near], y[near]], axis=1))
            a_lo, a_hi, b_lo, b_hi, err = a_lo[~leaf], a_hi[~leaf], b_lo[~leaf], b_hi[~leaf], err[~leaf]
    return np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)


def _least_reachable(values: np.ndarray, pairs: np.ndarray, direct: bool = False) -> np.ndarray:
    """For each item the smallest of ``values`` among what its pairs reach (``direct``: in one step)."""
    label = values.copy()
    while True:
        before = label.copy()
        low = np.minimum(before[pairs[:, 0]], before[pairs[:, 1]])
        np.minimum.at(label, pairs[:, 0], low)
        np.minimum.at(label, pairs[:, 1], low)
        if direct or (before == label).all():
            return label


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(left rotation, width) of each of budget + 1 blocks."""
    edges = [round(i * BITS / (budget + 1)) for i in range(budget + 2)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def _rotated(column: F.Column, by: int) -> F.Column:
    return column if not by else F.shiftleft(column, by).bitwiseOR(F.shiftrightunsigned(column, BITS - by))


def trie_links(nodes: DataFrame, budget: int, *, unit_cap: int = UNIT_CAP, direct: bool = False) -> DataFrame:
    """Links ``(a, b)`` that connect, directly or through others, all ``nodes`` (``id``, distinct ``fp``) within ``budget`` bits.

    Inside a unit the links found are reduced to one per node, to the smallest id that the unit's links
    reach: no connection is lost and the output is never larger than the unit. ``direct``: to the smallest id within the budget
    itself, so that each link is a pair that a check can judge; then nodes may stay apart that only larger ids connect. A unit is one
    trie node with itself (side 0), or two nodes (sides 1 and 2) whose paths differ in ``err`` bits so far.
    """
    rotations = [
        F.struct(
            F.lit(width).alias("depth"), F.lit(0).alias("err"), F.lit(0).alias("side"),
            F.concat(F.lit(f"{n}:"), F.hex(F.shiftrightunsigned(_rotated(F.col("fp"), turn), BITS - width))).alias("unit"),
            _rotated(F.col("fp"), turn).alias("key"),
        )
        for n, (turn, width) in enumerate(_blocks(budget))
    ]
    keyed = nodes.where("id is not null").select("id", F.explode(F.array(*rotations)).alias("x")).select("id", "x.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pa.compute.list_value_length(batch.column(0)).to_numpy())
            at = 0
            while at < batch.num_rows:  # as many units as hold about SLICE fingerprints, but one at least
                held = ends[at - 1] if at else 0
                more = max(at + 1, int(np.searchsorted(ends, held + SLICE, "right")))
                lists, at = batch.column(0).slice(at, more - at), more
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten()
                ids, keys, side = flat.field("id").to_numpy(), flat.field("key").to_numpy().view(np.uint64), flat.field("side").to_numpy()
                unit = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((keys, side, unit))
                ids, keys, bounds = ids[order], keys[order], np.concatenate([[0], np.cumsum(sizes)])
                first = np.bincount(unit, side == 1, minlength=len(sizes)).astype(np.int64)
                pairs = trie_pairs(keys, bounds, budget, np.where(first > 0, bounds[:-1] + first, 0))
                root = _least_reachable(ids, pairs, direct)
                linked = root != ids
                yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(root[linked])], names=["a", "b"])

    out = written = None
    while True:
        sizes = keyed.groupBy("unit").agg(F.count("*").alias("size"), F.min("side").alias("least"), F.max("side").alias("most"))
        sizes = sizes.where("size > 1 and (most = 0 or least < most)").select("unit", "size")
        keyed = keyed.join(sizes, "unit")
        units = keyed.where(F.col("size") <= unit_cap).groupBy("unit").agg(F.collect_list(F.struct("id", "key", "side")).alias("items"))
        links = materialise(units.select("items").mapInArrow(run, "a long, b long"), "unit-links")
        out = links if out is None else out.union(links)
        if sizes.where(F.col("size") > unit_cap).isEmpty():
            discard(written)
            return out
        own = F.shiftrightunsigned(F.call_function("shiftleft", F.col("key"), F.col("depth")), BITS - SPLIT_BITS)
        masks = F.array(*[F.lit(m).cast("long") for m in range(1 << SPLIT_BITS) if bin(m).count("1") <= budget])
        big = keyed.where((F.col("size") > unit_cap) & (F.col("depth") < BITS)).select("*", own.alias("own"), F.explode(masks).alias("m"))
        big = big.withColumn("err", F.col("err") + F.bit_count("m").cast("int")).where(F.col("err") <= budget).withColumn("other", F.col("own").bitwiseXOR(F.col("m")))
        alone = (F.col("side") == 0) & (F.col("m") == 0)
        side = F.when(alone, 0).when(F.col("side") > 0, F.col("side")).when(F.col("own") < F.col("other"), 1).otherwise(2)
        big = big.withColumn("side", side)
        name = F.concat_ws(".", "unit", F.when(F.col("side") == 2, F.col("other")).otherwise(F.col("own")), F.when(F.col("side") == 2, F.col("own")).otherwise(F.col("other")), F.when(alone, F.lit("=")).otherwise(F.lit("x")))
        before, written = written, materialise(big.select("id", (F.col("depth") + SPLIT_BITS).alias("depth"), "err", "side", name.alias("unit"), "key"), "units")
        discard(before)
        keyed = written


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, budget: int = 2, unit_cap: int = UNIT_CAP) -> DataFrame:
    """``id``, ``fp`` and ``component_id`` (the smallest id that links of at most ``budget`` bits reach) for every row."""
    marks = materialise(fingerprints(docs, id_col=id_col, text_col=text_col, words=words), "fingerprints")
    nodes = materialise(marks.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "nodes")
    roots = connected_components(trie_links(nodes.select(F.col("fp").alias("id"), "fp"), budget, unit_cap=unit_cap))
    rooted = materialise(nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", "copies", F.coalesce("root", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.join(least, "root").select("fp", "component_id", "copies"), "components")
    return lookup(marks, named, "fp", "copies").select("id", "fp", "component_id")


def common_shingles(source: DataFrame, words: int, *, sample: int = SAMPLE, most: int = COMMON) -> np.ndarray:
    """Hashes of shingles that several of about ``sample`` texts have, the most common last: ``most`` of them at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(x.as_py(), words).view(np.int64))], names=["hash"])

    step = max(1, math.ceil(source.count() / sample))
    counted = source.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).select("text").mapInArrow(run, "hash long").groupBy("hash").count()
    top = counted.where("count > 1").orderBy(F.desc("count"), "hash").limit(most).toArrow()
    return top.column("hash").to_numpy().view(np.uint64)[::-1].copy()


def prefixes(source: DataFrame, words: int, similarity: float, common: np.ndarray) -> DataFrame:
    """``source`` without its ``text``, and of the shingle set: ``digest`` (128 bits), size ``n``, fingerprint ``fp``, ``sketch`` (see ``parity_sketch``) and ``prefix``, its first shingles in one order of all shingles.

    The order puts ``common`` ones last. Two sets that are ``similarity`` alike share a shingle of their prefixes, whatever the order:
    a prefix is as long as all but one of the shingles that the set may lack.
    """
    order = np.argsort(common)
    known, rank = common[order], order + 1
    fields = [*source.drop("text").schema, T.StructField("digest", T.BinaryType()), T.StructField("n", T.IntegerType()), T.StructField("fp", T.LongType()), *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("sketch", "prefix")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, marks, sketches, firsts = [], [], [], [], []
            for x in batch.column(batch.num_columns - 1):
                own = shingle_set(x.as_py(), words)
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                sizes.append(len(own))
                marks.append(majority(own[at : at + BLOCK] for at in range(0, len(own), BLOCK)))
                sketches.append(parity_sketch(own))
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    own = own[np.argsort(np.where(known[at] == own, rank[at], 0), kind="stable")]
                firsts.append(own[: len(own) - math.ceil(similarity * len(own) - SLACK) + 1].view(np.int64))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (sketches, firsts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(marks, pa.int64()), *lists], names=[f.name for f in fields])

    return source.select(*source.drop("text").columns, "text").mapInArrow(run, T.StructType(fields))


def alike(links: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of the ``links`` whose ``texts`` (``id``, ``text``) have that Jaccard similarity of shingle sets, exactly, and ``sim``.

    Only texts that a link names are moved.
    """
    links = materialise(links.select("a", "b").distinct(), "candidates")
    wanted = materialise(links.select(F.col("a").alias("want")).union(links.select("b")).distinct(), "wanted")
    ids = wanted.count()
    known = F.broadcast(wanted) if ids <= MAX_BROADCAST_IDS else wanted
    own = materialise(texts.join(known, F.col("id") == F.col("want"), "left_semi").select("id", "text"), "wanted-texts")
    written = [links, wanted, own]
    if own.count() > ids:  # rows repeat
        own = materialise(own.dropDuplicates(["id"]), "wanted-texts")
        written.append(own)
    sides = links.join(own.select(F.col("id").alias("a"), F.col("text").alias("x")), "a").join(own.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def shingles(name: int, text: pa.Scalar) -> np.ndarray:
            if name not in held:
                if len(held) >= 64:
                    held.clear()
                held[name] = shingle_set(text.as_py(), words)
            return held[name]

        for batch in batches:
            keep, sims = [], []
            for a, b, x, y in zip(*batch.columns):
                one, two = shingles(a.as_py(), x), shingles(b.as_py(), y)
                both = len(np.intersect1d(one, two, assume_unique=True))
                either = len(one) + len(two) - both
                keep.append(both >= similarity * either - SLACK)
                sims.append(both / max(1, either))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([*[c.filter(mask) for c in batch.columns[:2]], pa.array(sims, pa.float64()).filter(mask)], names=["a", "b", "sim"])

    found = materialise(sides.mapInArrow(run, "a long, b long, sim double"), "alike")
    for table in written:
        discard(table)
    return found


def fingerprint_links(sets: DataFrame, texts: DataFrame, words: int, similarity: float, *, budget: int = BUDGET, unit_cap: int = UNIT_CAP) -> DataFrame:
    """Links ``(a, b)`` of ``sets`` (``id``, ``fp``) by the trie self-join of their fingerprints, each verified on the ``texts``.

    A fingerprint stands for its smallest id; sets of equal fingerprints are held against that one.
    """
    nodes = materialise(sets.groupBy("fp").agg(F.min("id").alias("node"), F.count("*").alias("copies")), "nodes")
    near = trie_links(nodes.select(F.col("node").alias("id"), "fp"), budget, unit_cap=unit_cap, direct=True)
    equal = lookup(sets.select("id", "fp"), nodes.where("copies > 1"), "fp", "copies").where("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    found = alike(near.select("a", "b").union(equal), texts, words, similarity).select("a", "b")
    discard(nodes)
    return found


def _may_be_alike(similarity: float) -> F.Column:
    """Of rows ``a`` and ``b`` of one shingle: the sizes allow that similarity, and what follows in both, if none of their common shingles comes earlier."""
    n, m = F.col("a.n"), F.col("b.n")
    rest = F.least(n - F.col("a.pos"), m - F.col("b.pos"))
    return (F.least(n, m) >= similarity * F.greatest(n, m) - SLACK) & (rest >= similarity / (1 + similarity) * (n + m) - SLACK)


def _sketches_allow(similarity: float) -> F.Column:
    """Of rows ``a`` and ``b``: their sketches differ in no more bits than sets so alike can in shingles.

    The larger sketch is folded to the length of the smaller; beyond one fold, which sizes so alike do not need, nothing is ruled out.
    """
    x, y = F.col("a.sketch"), F.col("b.sketch")
    odd = lambda u, v: F.zip_with(u, v, lambda p, q: p.bitwiseXOR(q))

    def folded(own: F.Column, other: F.Column) -> F.Column:
        half = F.floor(F.size(own) / 2).cast("int")
        return F.when(F.size(own) > F.size(other), odd(F.slice(own, 1, half), F.slice(own, half + 1, half))).otherwise(own)

    differ = F.aggregate(odd(folded(x, y), folded(y, x)), F.lit(0), lambda n, p: n + F.bit_count(p).cast("int"))
    return F.coalesce(differ, F.lit(0)) <= (1 - similarity) / (1 + similarity) * (F.col("a.n") + F.col("b.n")) + 1e-6


def _may_join(similarity: float) -> F.Column:
    """Of rows ``a`` and ``b``: nothing connects them yet, and their sketches allow that similarity."""
    return (F.col("a.root") != F.col("b.root")) & _sketches_allow(similarity)


def _crossed(left: DataFrame, right: DataFrame, sketches: DataFrame, keys: list[str], allowed: F.Column) -> DataFrame:
    """Rows ``a`` of ``left`` beside rows ``b`` of ``right`` of equal ``keys`` where ``allowed``, in cells of about ``CELL`` rows of each, so that no key fills a task.

    Both get the ``sketch`` of their ``id`` from ``sketches``, and only rows that meet others do.
    """
    chunks = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.count("*") / CELL).cast("int").alias(name))
    cells = materialise(chunks(left, "across").join(chunks(right, "down"), keys), "cells")

    def side(df: DataFrame, own: str, other: str, name: str) -> DataFrame:
        met = df.join(cells, keys).join(sketches, "id")
        return met.select(*keys, F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other), F.struct(*df.columns, "sketch").alias(name))

    return side(left, "across", "down", "a").join(side(right, "down", "across", "b"), [*keys, "across", "down"]).where(allowed)


def _possible(pairs: DataFrame, sets: DataFrame, allowed: F.Column) -> DataFrame:
    """Those of ``pairs`` ``(a, b)`` of ``sets`` (``id``, ``n``, ``root``, ``sketch``) that are ``allowed``. No text is moved."""
    side = lambda name: sets.select(F.col("id").alias(f"{name}_id"), F.struct("id", "n", "root", "sketch").alias(name))
    left = pairs.select(F.col("a").alias("one"), F.col("b").alias("two")).distinct().join(side("a"), F.col("one") == F.col("a_id"))
    return left.join(side("b"), (F.col("two") == F.col("b_id")) & allowed).select("one", "two").toDF("a", "b")


def similar_links(sets: DataFrame, texts: DataFrame, words: int, similarity: float, *, crowd: int = CROWD, rounds: int = ROUNDS) -> DataFrame:
    """Links ``(a, b)`` that connect all ``sets`` (``id``, ``n``, ``fp``, ``sketch``, ``prefix``) whose ``texts`` are ``similarity`` alike, each of them verified.

    The trie self-join of the fingerprints comes first; what it links, and what such links connect, is one group. Fingerprints of 64 bits
    can't tell all that are so alike, so the rest is found exactly, between groups only: sets so alike share a shingle of their prefixes, and
    all pairs that share one are verified but those that sizes, places of the shingle or sketches rule
    out, and but what crowds spare: there, a shingle's texts are first compared with a leader, that whose shingles are the most common, as
    the origin of copies is. Texts alike to it are one group with it. Another text needs to be compared only with those of the group that
    are not nearer to the leader than to the text can be: distances of Jaccard keep the triangle inequality. The group then leaves, and of
    the rest the next one leads. After ``rounds`` of that, what is left is compared pair by pair, however much it is.

    A text has as many rows in crowds as crowded shingles, so these rows hold numbers only; sketches stay in one table with a row for each text.
    """
    low = 2 * similarity - 1
    links = [fingerprint_links(sets.select("id", "fp"), texts, words, similarity)]
    groups = connected_components(links[0])
    known = materialise(sets.join(groups, F.col("id") == F.col("node"), "left").select("id", "n", F.coalesce("root", "id").alias("root"), "sketch"), "groups")
    sketches = known.select("id", "sketch")
    keys = sets.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    sizes = materialise(keys.groupBy("token").agg(F.count("*").alias("size")).where("size > 1"), "shingle-sizes")
    keyed = materialise(lookup(keys, sizes, "token", "size").select("id", "n", "pos", "token", "size"), "shingles")
    pairs = [_pairs(keyed.where(F.col("size") <= crowd).drop("size"), similarity)]
    live = _ungrouped(keyed.where(F.col("size") > crowd).join(known.select("id", "root"), "id"))
    discard(sizes)
    discard(keyed)
    for _ in range(rounds):
        if live.isEmpty():
            break
        fame = live.groupBy("id").agg(F.sum("size").alias("fame"))
        led = live.join(fame, "id").groupBy("token").agg(F.min(F.struct((-F.col("fame")).alias("f"), "id", "n")).alias("x"), F.count("*").alias("weight"))
        led = materialise(led.select("token", F.col("x.id").alias("leader"), F.col("x.n").alias("m"), "weight"), "leaders")
        met = materialise(lookup(live.drop("size"), led, "token", "weight").where("id <> leader"), "followers")
        near = met.where(F.least("n", "m") >= low * F.greatest("n", "m") - SLACK)
        sims = alike(_possible(near.select(F.col("id").alias("a"), F.col("leader").alias("b")), known, _sketches_allow(low)), texts, words, low)
        linked = F.col("sim") >= similarity - SLACK
        links.append(sims.where(linked).select("a", "b"))
        seen = met.join(sims.withColumnsRenamed({"a": "id", "b": "leader"}), ["id", "leader"], "left").select("token", "leader", "id", "n", "pos", "root", "sim")
        seen = materialise(seen, "compared")
        apart = F.col("a.sim") - F.col("b.sim") <= 1 - similarity + 1e-6
        fringe = _crossed(seen.where(linked), seen.where(~linked), sketches, ["token", "leader"], apart & _may_be_alike(similarity) & _may_join(similarity))
        pairs.append(materialise(fringe.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct(), "pairs"))
        rest = seen.where(F.col("sim").isNull() | ~linked).select("id", "n", "pos", "root", "token")
        left = materialise(rest.groupBy("token").agg(F.count("*").alias("size")).where("size > 1"), "shingle-sizes")
        rest = materialise(lookup(rest, left, "token", "size").select("id", "n", "pos", "root", "token", "size"), "shingles")
        pairs.append(_pairs(rest.where(F.col("size") <= crowd).drop("size"), similarity))
        before, live = live, _ungrouped(rest.where(F.col("size") > crowd))
        for table in (before, led, met, seen, left, rest):
            discard(table)
    else:
        pairs.append(_pairs(live.drop("size"), similarity, sketches))
    found = alike(_possible(reduce(DataFrame.union, pairs), known, _may_join(similarity)), texts, words, similarity).select("a", "b")
    for table in (known, live, *pairs):
        discard(table)
    return reduce(DataFrame.union, links, found)


def _ungrouped(live: DataFrame) -> DataFrame:
    """Rows of shingles that not only sets of one group (``root``) have."""
    spread = live.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("token")
    return materialise(live.join(spread, "token", "left_semi"), "crowds")


def _pairs(keyed: DataFrame, similarity: float, sketches: DataFrame | None = None) -> DataFrame:
    """Pairs ``(a, b)`` of ids that share a shingle and may be alike. With ``sketches`` a shingle may have any number of texts."""
    if sketches is not None:
        found = _crossed(keyed, keyed, sketches, ["token"], (F.col("a.id") < F.col("b.id")) & _may_be_alike(similarity) & _may_join(similarity))
    else:
        side = lambda name: keyed.select("token", F.struct("id", "n", "pos").alias(name))
        found = side("a").join(side("b"), "token").where((F.col("a.id") < F.col("b.id")) & _may_be_alike(similarity))
    return materialise(found.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct(), "pairs")


def _numbered(docs: DataFrame, key: str, text_col: str, words: int, similarity: float) -> tuple[DataFrame, DataFrame, bool]:
    """``id`` (a number), ``row`` and ``text`` of all rows with an id; what ``prefixes`` says of them; whether rows repeat.

    The number is a hash of the row's key. If two keys ever share one, all are hashed anew.
    """
    seed, common = 0, None
    while True:
        source = docs.where(F.col(key)["id"].isNotNull()).select(F.xxhash64(F.lit(seed), F.col(key)).alias("id"), F.col(key).alias("row"), F.col(f"`{text_col}`").cast("binary").alias("text"))
        common = common_shingles(source, words) if common is None else common
        marks = materialise(prefixes(source, words, similarity, common), "marks")
        shared = marks.groupBy("id").agg(F.count("*").alias("n"), F.min("row").alias("lo"), F.max("row").alias("hi")).where("n > 1")
        twice, clashes = shared.agg(F.count("*"), F.count_if(F.col("lo") != F.col("hi"))).first()
        if not clashes:
            return source, marks, bool(twice)
        discard(marks)
        seed += 1


def _classes(marks: DataFrame, repeated: bool, max_broadcast: int = MAX_BROADCAST_IDS) -> DataFrame:
    """One row of ``marks`` for each ``digest``, that of the smallest ``row``, without the digest.

    Up to ``max_broadcast`` ids of the others go to all tasks, and prefixes stay where they are.
    """
    columns = ["id", "row", "n", "fp", "sketch", "prefix"]
    if not repeated:
        least = marks.groupBy("digest").agg(F.min(F.struct("row", "id")).alias("least"), F.count("*").alias("copies")).where("copies > 1").select("digest", F.col("least.id").alias("first"))
        others = materialise(marks.select("id", "digest").join(least, "digest").where("id <> first").select("id"), "copies")
        found = materialise(marks.join(F.broadcast(others), "id", "left_anti").select(columns), "texts") if others.count() <= max_broadcast else None
        discard(others)
        if found is not None:
            return found
    classes = marks.groupBy("digest").agg(F.min(F.struct("row", *[c for c in columns if c != "row"])).alias("least"))
    return materialise(classes.select("least.*").select(columns), "texts")


def _repeats(marked: DataFrame, key: str, text_col: str, words: int, similarity: float) -> tuple[DataFrame, bool]:
    """``row`` of all but the smallest of each group of near-duplicates, in a written table; whether rows repeat. What else was written is deleted, but for tables of links."""
    source, marks, repeated = _numbered(marked, key, text_col, words, similarity)
    texts = _classes(marks, repeated)
    rows = materialise(marks.select("id", "row"), "rows")
    discard(marks)
    roots = connected_components(similar_links(texts.drop("row"), source, words, similarity))
    rooted = texts.join(roots, texts["id"] == roots["node"], "left").select("id", "row", F.coalesce("root", "id").alias("root"))
    kept = rooted.groupBy("root").agg(F.min(F.struct("row", "id")).alias("least")).select("least.id")
    gone = materialise(rows.join(kept, "id", "left_anti").select("row"), "repeats")
    discard(texts)
    discard(rows)
    return gone, repeated


@in_small_batches
def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row, that of the smallest id, of each group of near-duplicates.

    Groups are the components of all pairs of texts that are ``similarity`` alike. Texts of equal shingle sets are the same.
    Rows are judged by their own text, whatever ids they share; of rows equal in id and text that stays whose other
    columns' hash is least. Rows without an id stay. Ids may be of any type that sorts.
    """
    marked, key = with_row_key(docs, id_col, text_col)
    with without_shuffle_files(docs.sparkSession):
        gone, repeated = _repeats(marked, key, text_col, words, similarity)
    left = without_rows(marked, key, gone)
    discard(gone)
    if repeated:
        rows = W.Window.partitionBy(key).orderBy(F.xxhash64(*[hashable(f) for f in docs.schema]))
        named = left.where(F.col(key)["id"].isNotNull()).withColumn(f"{key}n", F.row_number().over(rows)).where(f"{key}n = 1").drop(f"{key}n")
        left = named.union(left.where(F.col(key)["id"].isNull()))
    return left.drop(key)
