"""URL filters over a sorted digest array.

A filter file holds the 64-bit xxhash of every rule in ascending order, where each rule's full string
lies, and the strings. It is written to the shared folder, fetched once by each executor, and
memory-mapped by its Python workers, which share its pages. For each URL the keys that a rule could have
(suffixes of the host with prefixes of the path, both of lengths that rules have) are hashed, probed with
one vectorised binary search for each ``SLICE_BYTES`` of keys, and confirmed against the stored strings, so that
colliding digests can't cause a hit. However long a URL is, its keys are as long as the rules.

Defined results: a null URL or one without ``://`` has empty host and path and fits no rule but one for
the empty host; the longest rule wins, of equally long ones that with the longer host; a rule given twice
with both actions blocks; without a rule the verdict is the filter's default. The list of rules is held
by the driver while it is built: at most ``MAX_RULES`` are taken.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import private, shared_dir

MAX_RULES = 10_000_000
ACTIONS = ("block", "allow")
#: Bytes of keys that are probed at a time.
SLICE_BYTES = 4 << 20
#: What a key takes besides its letters.
KEY_BYTES = 64
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:end].translate(_LOWER), tail[:stop]


def build(rules: Iterable[tuple[str, str, str]], default: str = "allow", digest=xxhash.xxh64_intdigest) -> bytes:
    """A filter file from ``(action, host, path)``: counts, digests, offsets, host length of each rule, all path lengths, all host lengths, actions, strings."""
    chosen: dict[bytes, tuple[int, int]] = {}
    for action, host, path in rules:
        host = host.translate(_LOWER)
        key = f"{host}\0{path}".encode()
        own = (ACTIONS.index(action), len(host.encode()))
        chosen[key] = min(chosen.get(key, own), own)
        if len(chosen) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules")
    rows = sorted((digest(k), k, *v) for k, v in chosen.items())
    paths, hosts = sorted({len(k) - n - 1 for _, k, _, n in rows}), sorted({n for *_, n in rows})
    offsets = np.concatenate([[0], np.cumsum([len(k) for _, k, _, _ in rows], dtype=np.int64)]).astype("<i8")
    return b"".join(
        [struct.pack("<4q", len(rows), len(paths), ACTIONS.index(default), len(hosts)), np.array([r[0] for r in rows], dtype="<u8").tobytes(), offsets.tobytes(), np.array([r[3] for r in rows], dtype="<i8").tobytes(), np.array(paths + hosts, dtype="<i8").tobytes(), bytes(r[2] for r in rows), b"".join(r[1] for r in rows)]
    )


class DigestArray:
    """A memory-mapped filter file."""

    def __init__(self, path: str, digest=xxhash.xxh64_intdigest):
        data = np.memmap(path, dtype=np.uint8, mode="r")
        self.n, paths, default, hosts = data[:32].view("<i8").tolist()
        self.default, self.digest = ACTIONS[default], digest
        at = 32

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            part = data[at : at + count * np.dtype(kind).itemsize].view(kind)
            at += part.nbytes
            return part

        self.digests, self.offsets, self.hosts = take(self.n, "<u8"), take(self.n + 1, "<i8"), take(self.n, "<i8")
        self.path_lengths, self.host_lengths = take(paths, "<i8").tolist(), take(hosts, "<i8").tolist()
        self.actions, self.strings = take(self.n, "u1"), data[at:]

    def _probe(self, owner: list[int], keys: list[bytes], best: dict[int, tuple[int, int, int]]) -> None:
        """Note each owner's longest rule among the keys: (length, host's length, number)."""
        if not keys or not self.n:
            return
        wanted = np.fromiter(map(self.digest, keys), dtype=np.uint64, count=len(keys))
        at = np.searchsorted(self.digests, wanted)
        live = np.nonzero((at < self.n) & (self.digests[np.minimum(at, self.n - 1)] == wanted))[0]
        while len(live):
            for j in live.tolist():
                k = int(at[j])
                if self.strings[self.offsets[k] : self.offsets[k + 1]].tobytes() == keys[j]:
                    best[owner[j]] = max(best.get(owner[j], (-1, -1, -1)), (len(keys[j]), int(self.hosts[k]), k))
            at[live] += 1  # the next of equal digests
            live = live[at[live] < self.n]
            live = live[self.digests[at[live]] == wanted[live]]

    def judge(self, urls: list[str | None]) -> list[tuple[str, str, str | None, str]]:
        """Host, path, rule and verdict of each URL."""
        split = [split_url(u) for u in urls]
        best: dict[int, tuple[int, int, int]] = {}
        owner, keys, held = [], [], 0
        for i, (host, path) in enumerate(split):
            labels, tail = host.encode(), path.encode()
            prefixes = [tail[:n] for n in self.path_lengths if n <= len(tail)]
            for n in self.host_lengths:
                start = len(labels) - n
                if start == 0 or start > 0 and labels[start - 1] == ord("."):
                    for prefix in prefixes:
                        key = labels[start:] + b"\0" + prefix
                        keys.append(key)
                        owner.append(i)
                        held += len(key) + KEY_BYTES
                        if held >= SLICE_BYTES:
                            self._probe(owner, keys, best)
                            owner, keys, held = [], [], 0
        self._probe(owner, keys, best)
        out = []
        for i, (host, path) in enumerate(split):
            if i in best:
                k = best[i][2]
                rule = self.strings[self.offsets[k] : self.offsets[k + 1]].tobytes().decode().replace("\0", "")
                out.append((host, path, rule, ACTIONS[self.actions[k]]))
            else:
                out.append((host, path, None, self.default))
        return out


@lru_cache(maxsize=4)
def _opened(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def publish(spark: SparkSession, content: bytes) -> str:
    """Put a filter file into the shared folder and name it to the executors."""
    name = f"rules-{hashlib.sha256(content).hexdigest()[:24]}.bin"
    path = f"{shared_dir(spark)}/{name}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(where):
        out = system.create(where, True)
        for at in range(0, len(content), 1 << 22):
            out.write(bytearray(content[at : at + (1 << 22)]))
        out.close()
        system.deleteOnExit(where)
    spark.sparkContext.addFile(path)
    return name


def judge(urls: DataFrame, rules: Iterable[tuple[str, str, str]], *, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict`` for every row of ``urls``."""
    source = private(urls, id=id_col, url=url_col).withColumn("url", F.col("url").cast("string"))
    name = publish(urls.sparkSession, build(rules, default))
    schema = T.StructType([source.schema["id"], *(T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _opened(name)
        for batch in batches:
            found = known.judge(batch.column(1).to_pylist())
            columns = [pa.array([f[i] for f in found], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return source.mapInArrow(run, schema)
