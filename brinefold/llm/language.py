"""Language identification by Bayesian evidence fusion.

Text gives likelihoods under one model of byte trigrams for each language, and under a background of
evenly spread trigrams that stands for no language (``und``). They are fused with what a document says
of itself (a declared language, whose reliability is a table of P(declared | language)), and with a prior
of its host. A host's prior is smoothed towards that of its address suffix, and that towards the prior of all:
``(n + k parent) / (total + k)``, where n are sums of the text's posteriors over all of the host's
other documents. Sums come from grouped aggregations that combine map-side; the row's own share is taken out.

The trigram models are fitted on a sample of at most about ``SAMPLE_ROWS`` labelled rows, chosen by a hash of
their ids; everything else covers all rows.

Defined results: a text without letters (null, empty, digits) is ``und`` with posterior 0 and rejected; a
null host or suffix is one of its own; a declared language that no model has counts as ``other``, a null or
empty one as none; equal posteriors go to the language that sorts first; repeated rows count each; ids may be of any
type, repeated or null: ``keep_identified`` judges rows, not ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_small_batches, materialise, private, with_row_key, without_rows

SAMPLE_ROWS = 4000
BUCKETS = 1 << 15
MAX_LANGUAGES = 200
NONE = "und"
#: Trigrams overlap: each byte is in three of them.
TEMPERATURE = 3.0
HOST_WEIGHT = 8.0
NONE_PRIOR = 1e-3
ACCEPT = 0.5
BLOCK = 1 << 20

_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def letters(text: str | None) -> bytes:
    """A lower-cased text between spaces, with a space for whatever is not a letter."""
    return f" {text or ''} ".lower().encode().translate(_LETTERS)


def trigrams(data: bytes) -> Iterator[np.ndarray]:
    """Hash buckets of the trigrams of what ``letters`` returns, in blocks; those with two spaces are none."""
    codes = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    for at in range(0, max(0, len(codes) - 2), BLOCK):
        x = codes[at : at + BLOCK + 2]
        code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
        code = code[((x[:-2] == 32).astype(np.uint8) + (x[1:-1] == 32) + (x[2:] == 32)) < 2]
        yield ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def fit(rows: DataFrame, *, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, the background last, and their log probabilities by bucket."""
    known = private(rows, id=id_col, text=text_col, label=label_col).where("label is not null and label <> ''")
    total = known.count()
    if not total:
        return [NONE], np.full((1, BUCKETS), -math.log(BUCKETS))
    share = min(1.0, sample_rows / total)
    chosen = known.where(F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1_000_000)) < math.ceil(share * 1_000_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                own = sums.setdefault(label.as_py(), np.zeros(BUCKETS, dtype=np.int64))
                for part in trigrams(letters(text.as_py())):
                    own += np.bincount(part, minlength=BUCKETS)
        for label, own in sums.items():
            at = np.nonzero(own)[0]
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["label", "bucket", "n"])

    counted = chosen.select("text", F.lower("label").alias("label")).mapInArrow(run, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most a row for each language and bucket
    labels = sorted(set(found["label"].to_pylist()))
    if len(labels) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(labels), BUCKETS))
    np.add.at(counts, ([labels.index(x) for x in found["label"].to_pylist()], found["bucket"].to_numpy()), found["n"].to_numpy())
    shared = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * BUCKETS)
    weight = 2000.0  # trigrams' worth of the shared distribution in each language's own
    logs = np.log((counts + weight * shared) / (counts.sum(axis=1, keepdims=True) + weight))
    return [*labels, NONE], np.vstack([logs, np.full(BUCKETS, -math.log(BUCKETS))])


def primary(tag: Column) -> Column:
    """Primary subtag of a language tag in lower case; null if empty."""
    found = F.lower(F.regexp_extract(tag, r"^\s*([A-Za-z]+)", 1))
    return F.when(found != "", found)


def suffix_of(host: Column) -> Column:
    """What follows the last dot of a host without its port; null without a dot."""
    found = F.regexp_extract(F.lower(host), r"\.([^.:/]+)\.?(?::\d+)?$", 1)
    return F.when(found != "", found)


def _shares(logs: np.ndarray) -> np.ndarray:
    powers = np.exp(logs - logs.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], *, host_weight: float = HOST_WEIGHT, accept: float = ACCEPT) -> DataFrame:
    """``rows`` has ``key``, ``text``, ``declared``, ``host``, ``suffix``.

    Returns ``key, declared, text_language, language, posterior, accepted`` for each row.
    """
    names, logs = model
    size = len(names)
    start = np.array([math.log(NONE_PRIOR if n == NONE else (1 - NONE_PRIOR) / max(1, size - 1)) for n in names])
    table = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(logs.T))  # languages x buckets, both bounded
    source = rows.select("key", F.col("text").cast("string"), primary(F.col("declared").cast("string")).alias("declared"), F.col("host").cast("string"), F.col("suffix").cast("string"))
    fields = [source.schema["key"], *(T.StructField(c, T.StringType()) for c in ("declared", "host", "suffix")), T.StructField("n", T.LongType()), *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("ll", "share"))]

    def likelihoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = table.value
        for batch in batches:
            counts, sums = [], np.zeros((batch.num_rows, size))
            for i, text in enumerate(batch.column(1)):
                data = letters(text.as_py())
                for part in trigrams(data):
                    sums[i] += np.bincount(part, minlength=BUCKETS) @ lookup if len(part) > BUCKETS else lookup[part].sum(axis=0)
                counts.append(len(data) - data.count(b" "))
            sums = (sums - sums.max(axis=1, keepdims=True)) / TEMPERATURE
            made = [pa.array(list(x), pa.list_(pa.float64())) for x in (sums, _shares(sums + start))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:5], pa.array(counts, pa.int64()), *made], names=[f.name for f in fields])

    scored = materialise(source.mapInArrow(likelihoods, T.StructType(fields)), "likelihoods")
    lettered = scored.where("n > 0")
    sums = lambda c: [F.sum(F.element_at(c, i + 1)).alias(f"s{i}") for i in range(size)]
    packed = F.array(*[F.col(f"s{i}") for i in range(size)])
    hosts = materialise(lettered.groupBy("host", "suffix").agg(F.count("*").alias("m"), *sums("share")).select("host", "suffix", "m", packed.alias("own")), "hosts")
    suffixes = hosts.groupBy(F.col("suffix").alias("x")).agg(F.sum("m").alias("xm"), *sums("own")).select("x", "xm", packed.alias("above"))
    overall = hosts.agg(F.sum("m").alias("m"), *sums("own")).first()
    base = (np.array([overall[i + 1] or 0.0 for i in range(size)]) + host_weight * np.exp(start)) / ((overall["m"] or 0) + host_weight)

    # P(declared | language), for the languages of the model, "other" and none
    told = F.when(F.col("declared").isNull(), F.lit("")).when(F.col("declared").isin(names), F.col("declared")).otherwise(F.lit("other"))
    seen = {r[0]: np.array(r[1:]) for r in lettered.groupBy(told.alias("told")).agg(*sums("share")).collect()}  # a row for each language and two
    weight, total = 4.0, sum(seen.values(), np.zeros(size))
    reliable = {k: np.log((v + weight * (v.sum() + 1) / (total.sum() + len(seen))) / (total + weight)) for k, v in seen.items()}

    parents = hosts.join(suffixes, F.col("suffix").eqNullSafe(F.col("x")), "left").select(F.col("host").alias("h"), F.col("suffix").alias("hx"), "m", "own", "xm", "above")
    joined = scored.join(parents, F.col("host").eqNullSafe(F.col("h")) & F.col("suffix").eqNullSafe(F.col("hx")), "left")
    joined = joined.select("key", "declared", "n", "ll", "share", told.alias("told"), "m", "own", "xm", "above")
    result = T.StructType([joined.schema["key"], *(T.StructField(c, T.StringType()) for c in ("declared", "text_language", "language")), T.StructField("posterior", T.DoubleType()), T.StructField("accepted", T.BooleanType())])

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = np.array(names, dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = dict(zip(batch.schema.names, batch.columns))
            grid = lambda c: np.array([x if x is not None else [0.0] * size for x in columns[c].to_pylist()])
            flat = lambda c: np.array([x or 0 for x in columns[c].to_pylist()], dtype=float)[:, None]
            some = (flat("n") > 0).astype(float)
            share = grid("share") * some
            # the row's own share is no evidence for itself
            above = (np.maximum(grid("above") - share, 0) + host_weight * base) / (np.maximum(flat("xm") - some, 0) + host_weight)
            prior = (np.maximum(grid("own") - share, 0) + host_weight * above) / (np.maximum(flat("m") - some, 0) + host_weight)
            said = np.array([reliable.get(t, np.zeros(size)) for t in columns["told"].to_pylist()])
            fused = _shares(grid("ll") + np.log(prior) + said)
            best, own, live = fused.argmax(axis=1), share.argmax(axis=1), some[:, 0] > 0
            top = np.where(live, fused.max(axis=1), 0.0)
            name = np.where(live, word[best], NONE)
            yield pa.RecordBatch.from_arrays(
                [columns["key"], columns["declared"], pa.array(np.where(live, word[own], NONE), pa.string()), pa.array(name, pa.string()), pa.array(top), pa.array((name != NONE) & (top >= accept), pa.bool_())], names=result.names
            )

    return joined.mapInArrow(fuse, result)


def page_evidence(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``key, text, declared, host, suffix`` of web pages: visible text, the markup's language and the address."""
    source = private(pages, key=id_col, url=url_col, html=html_col)
    html = F.col("html").cast("string")
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>|&[#A-Za-z0-9]{1,12};", " ")
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"://(?:[^/?#@]*@)?([^/?#]*)", 1))
    host = F.when(host != "", host)
    declared = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    return source.select("key", text.alias("text"), declared.alias("declared"), host.alias("host"), suffix_of(host).alias("suffix"))


def document_evidence(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The same of documents: the source is the host."""
    source = private(docs, key=id_col, text=text_col, declared=declared_col, host=source_col)
    return source.select("key", "text", "declared", "host", suffix_of(F.col("host").cast("string")).alias("suffix"))


@in_small_batches
def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", **names: str) -> DataFrame:
    """``docs`` without the rows whose language stays undetermined or unsure, each judged by its own text, declaration and source."""
    used = {"text_col": "text", "declared_col": "lang", "source_col": "source"} | names
    marked, key = with_row_key(docs, id_col, *used.values())
    judged = identify(document_evidence(marked, id_col=key, **used), fit(docs, id_col=id_col, text_col=used["text_col"], label_col=used["declared_col"]))
    return without_rows(marked, key, judged.where(~F.col("accepted")).select("key")).drop(key)
