"""A key holding a third of the target: the anti join is split by AQE and
the result stays whole."""

from pyspark.sql import functions as F

from tablesync.operators import upsert

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_key_anti_join(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        n = 300_000
        target = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("jira"), F.col("id").alias("v")
        )
        # keys: every 5th id (not the hot key), duplicated, plus NULLs
        keys = spark.range(0, n, 5).select(F.col("id").alias("jira")).unionByName(
            spark.range(0, n, 5).select(F.col("id").alias("jira"))
        ).unionByName(spark.range(10).select(F.lit(None).cast("bigint").alias("jira")))
        out = upsert.delete_by_keys(target, keys)
        qe = out._jdf.queryExecution()
        kept = qe.toRdd().count()
        plan = qe.executedPlan().toString()
        expected = n - len([i for i in range(n) if i % 3 != 0 and i % 5 == 0])
        assert kept == expected  # nothing dropped, nothing duplicated
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
