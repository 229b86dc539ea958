import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from brinefold.llm import common, language, simhash


def test_rows_go_and_not_ids(spark):
    docs = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x"), (2, "y"), (3, "x"), (None, "x"), (None, None)], "doc_id long, __row string")
    marked, key = common.with_row_key(docs, "doc_id", "__row")
    assert key == "__row_"
    gone = marked.where("doc_id = 2 and __row = 'x' or doc_id is null and __row is null").select(F.col(key).alias("k"))
    for most in (10, 0):
        left = common.without_rows(marked, key, gone, most).drop(key)
        assert left.columns == docs.columns
        assert sorted(map(tuple, left.collect()), key=repr) == sorted([(1, "x"), (2, "y"), (3, "x"), (None, "x")], key=repr)
    assert common.without_rows(marked, key, gone.limit(0)).count() == 7


@pytest.mark.parametrize("hot", [0, 1, 1000])
def test_lookup_is_an_inner_join(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_KEYS", hot)
    left = spark.createDataFrame([(i, i % 7 if i % 3 else 0) for i in range(300)] + [(300, None), (301, 99)], "id long, k long")
    right = common.materialise(left.where("k < 50").groupBy("k").agg(F.count("*").alias("w")).withColumn("value", F.col("k") * 10), "right")
    got = common.lookup(left, right, "k", "w")
    assert sorted((r.id, r.k, r.value) for r in got.collect()) == sorted((r.id, r.k, r.k * 10) for r in left.where("k < 50").collect())


def test_shared_folder_is_read_from_the_session(spark):
    def session(named, master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": named}[key] or default), sparkContext=SimpleNamespace(master=master, applicationId=f"test-{master}"))

    assert common.shared_dir(session("hdfs:///shared/", "spark://x:7077")) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        common.shared_dir(session(None, "spark://x:7077"))
    with pytest.raises(RuntimeError):
        common.shared_dir(session(None, "local-cluster[2,1,1024]"))
    assert common.shared_dir(session(None, "local[2]")).startswith("file:///")
    assert common.shared_dir(spark) == common.shared_dir(spark)


BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.mark.parametrize("own", [None, "300", "5000", "0"])
def test_small_batches(spark, own):
    def most():
        def run(batches):
            for batch in batches:
                yield batch.from_pydict({"n": [batch.num_rows]})

        return max(r.n for r in spark.range(0, 4000, 1, 1).mapInArrow(run, "n long").collect())

    if own:
        spark.conf.set(BATCHES, own)
    try:
        outside = most()
        with common.small_batches(spark):
            assert most() == min(int(own or 0) or common.BATCH_ROWS, common.BATCH_ROWS)
        with pytest.raises(ZeroDivisionError), common.small_batches(spark):
            1 / 0  # noqa: B018
        assert spark.conf.get(BATCHES, None) == own and most() == outside
    finally:
        spark.conf.unset(BATCHES)


def test_queries_leave_no_shuffle_files(spark):
    files = lambda: sum("shuffle_" in x for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))
    df = spark.range(50_000).groupBy((F.col("id") % 20_011).alias("k")).agg(F.max("id").alias("m"))
    with common.without_shuffle_files(spark):
        before = files()
        made = common.materialise(df, "test")
        assert made.join(df, "k").count() == 20_011
        end = time.time() + 20
        while files() > before and time.time() < end:
            time.sleep(0.1)
        assert files() <= before
    common.discard(made)


def test_stages_with_python_send_small_batches(spark, monkeypatch):
    """The pipeline's check ended for the memory that batches of 10,000 texts left behind in executors and their workers."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for module, stage in ((language, language.keep_identified), (simhash, simhash.deduplicate)):
        seen = []

        def write(df, label, real=common.materialise):
            seen.append((label, int(spark.conf.get(BATCHES))))
            return real(df, label)

        for where in (module, common):
            monkeypatch.setattr(where, "materialise", write)
        kept = stage(docs)
        assert "gone" in dict(seen) and {n for _, n in seen} == {common.BATCH_ROWS}
        assert "MapInArrow" not in kept._jdf.queryExecution().executedPlan().toString()
        monkeypatch.undo()
