import time

from pyspark.sql import functions as F

from playline.session import SHUFFLE_CLEANUP, stage


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = disk.getAllFiles().mkString("\n").split("\n")
    return {name for name in names if name.rsplit("/")[-1].startswith("shuffle_")}


def test_a_stage_leaves_no_shuffle_files(spark):
    before, kept = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    counted = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    staged = stage(counted, "cleaned")
    for _ in range(100):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert staged.agg(F.count("k"), F.sum("count")).first() == (700, 5000)
    # The same rows again, which are computed anew.
    assert stage(counted, "cleaned").count() == 700
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == kept
