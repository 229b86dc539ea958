"""What the corpus operators share: tables in the shared folder and connected components."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only a local master may go without that setting; it then gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN_DIR:
        _OWN_DIR[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="brinefold-")
    return _OWN_DIR[context.applicationId]


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again: lineage ends there,
    the rows are computed once, and a lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made.written_to = path
    return made


#: Rows that go to a Python worker at a time where ``in_small_batches`` holds. Spark's 10,000 texts of some kilobytes, or pairs of
#: them, take tens of MB in each task, outside the heap and again in the worker, and neither gives them all back.
BATCH_ROWS = 1000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's ``key`` is ``value`` inside, and what it was before afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that begin inside send at most ``BATCH_ROWS`` rows at a time to a Python worker. The session's own setting holds if it is smaller, and again afterwards."""
    now = int(spark.conf.get(_BATCH_KEY))
    with setting(spark, _BATCH_KEY, str(min(now, BATCH_ROWS) if now > 0 else BATCH_ROWS)):
        yield


def in_small_batches(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions of a table that run their Python before they return: it runs under ``small_batches``."""

    @functools.wraps(f)
    def run(docs: DataFrame, *args, **named) -> DataFrame:
        with small_batches(docs.sparkSession):
            return f(docs, *args, **named)

    return run


#: Spark's setting by which a query's shuffle files go when it ends, not when the driver's JVM happens to collect its garbage.
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def without_shuffle_files(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries made inside leave no shuffle files. Tables that outlive it are to be made outside, as a second run of one of them would compute its shuffles anew."""
    return setting(spark, _CLEANUP_KEY, "true")


def discard(table: DataFrame | None) -> None:
    """Delete a written table that no plan needs any more."""
    if table is not None:
        drop_path(table.sparkSession, table.written_to)


def private(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names that cannot clash with the caller's others."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


#: Ids or keys of rows that may be broadcast to every task: some 30 MB of them.
MAX_BROADCAST_IDS = 1_000_000


def hashable(field: T.StructField) -> Column:
    """The column, or its spelling if there are maps or variants in it, which have no hash."""
    spelled = any(kind in str(field.dataType.jsonValue()) for kind in ("'map'", "variant"))
    return F.col(f"`{field.name}`").cast("string") if spelled else F.col(f"`{field.name}`")


def with_row_key(docs: DataFrame, id_col: str, *judged: str) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: what tells rows apart for an operator that looks at ``judged`` columns.

    It holds the id, of any type, and a hash of the others, so that rows are judged as rows where ids repeat or are null.
    """
    key = "__row"
    while key in docs.columns:
        key += "_"
    return docs.withColumn(key, F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in judged]).alias("mark"))), key


def without_rows(docs: DataFrame, key: str, gone: DataFrame, max_broadcast: int = MAX_BROADCAST_IDS) -> DataFrame:
    """``docs`` but for rows whose ``key`` (see ``with_row_key``) is in ``gone``'s only column.

    The keys are written and counted first. Up to ``max_broadcast`` of them go to all tasks, and the documents
    with their texts stay where they are; more of them meet the documents in a shuffle.
    """
    name = gone.columns[0]
    listed = materialise(gone.select(F.col(f"{name}.id").alias("__gone"), F.col(f"{name}.mark").alias("__mark")).distinct(), "gone")
    known = F.broadcast(listed) if listed.count() <= max_broadcast else listed
    own = F.col(key)
    return docs.join(known, own["id"].eqNullSafe(F.col("__gone")) & (own["mark"] == F.col("__mark")), "left_anti")


#: Keys whose rows meet the other side through a broadcast: that many at most, whatever the size of the data.
HOT_KEYS = 1000


def lookup(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of many rows with a written table that has one row for each ``key``, and in ``weight`` how many rows of ``left`` have it.

    Rows of the ``HOT_KEYS`` heaviest keys find them in a broadcast of just those and are not shuffled, so that no key
    fills a partition; the others are joined by a shuffle, or as adaptive execution sees fit. ``left`` is read twice.
    """
    hot = materialise(right.orderBy(F.desc(weight), key).limit(HOT_KEYS), "hot-keys")
    cold = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right, key)
    return left.join(F.broadcast(hot), key).unionByName(cold)


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of undirected links ``(a, b)`` of orderable ids, as ``(node, root)`` with the smallest id as root.

    Alternating large-star and small-star rounds: every round is a grouped minimum (combined map-side)
    and a join that adaptive execution may split, and its links are written to the shared folder.
    Links from a node to itself, repeats and nulls add nothing.
    """
    spark = links.sparkSession
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialise(links, "links")
    mark = None
    for _ in range(max_rounds):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        before, links = links, materialise(small.where("a <> b").distinct(), "links")
        discard(before)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = tuple(now)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
