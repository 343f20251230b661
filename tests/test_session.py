import os

from pyspark.sql import functions as F

from quadrille.plans import load
from quadrille.session import PARTITIONS, TASK_BYTES, checkpoint_dir, cut, measured_bytes, scope, scratch, tune

SMALL = "/root/testdata/sf0.001"


def held(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_a_scope_leaves_no_scratch_behind(spark, tmp_path):
    queries, before = load()[0], held(spark)
    for name in ("path_reachable", "paths_shortest", "commit_counts"):
        with scope(spark):
            queries[name](spark, SMALL).write.parquet(f"{tmp_path}/{name}")
            assert held(spark) > before
        assert held(spark) == before and spark.read.parquet(f"{tmp_path}/{name}").count() > 0


def test_scopes_nest_and_clean_up_after_errors(spark):
    before = held(spark)
    with scope(spark):
        outer = cut(spark.range(5))
        try:
            with scope(spark):
                cut(spark.range(3))
                raise KeyError
        except KeyError:
            pass
        assert outer.count() == 5 and len(held(spark) - before) == 1
    assert held(spark) == before
    assert scratch(spark, "x") != scratch(spark, "x")


def test_binary_values_are_measured(spark):
    rows = spark.range(10).select(F.repeat(F.lit("x"), 1000).cast("binary").alias("b"))
    assert measured_bytes(rows) >= 10_000


def test_what_a_task_reads_is_bounded_and_smaller_sizes_stay(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    other.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    tune(other)
    assert other.conf.get("spark.sql.files.maxPartitionBytes") == str(TASK_BYTES)
    assert other.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16k"
    assert int(other.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= PARTITIONS
    assert other.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_small_files_of_wide_text_are_not_broadcast(spark, capsys):
    # 500,000 IRIs take some MB in a file and ten times that as rows.
    rows = cut(spark.range(500_000).select(F.concat(F.lit("http://example.org/data/customer/c_custkey="), F.col("id")).alias("s"), F.lit("http://example.org/data/livesIn").alias("p")))
    rows.join(rows.select("s"), "s").explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out
