"""Plan-shape checks: the physical plans the scale argument relies on."""

from tablesync.plans import registry


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_delete_is_anti_join_not_null_aware(spark, sf_dir):
    plan = _plan(registry.QUERIES["delete_by_keys"](spark, sf_dir))
    assert "LeftAnti" in plan
    assert "BroadcastNestedLoopJoin" not in plan  # NOT IN (subquery) would plan this


def test_upsert_prunes_columns_and_pushes_filter(spark, sf_dir):
    plan = _plan(registry.QUERIES["upsert"](spark, sf_dir))
    assert "GreaterThan(o_orderdate" in plan
    assert "o_custkey" not in plan and "o_orderpriority" not in plan


def test_watermark_is_partial_then_final_max(spark, sf_dir):
    plan = _plan(registry.QUERIES["watermark_max"](spark, sf_dir))
    assert "partial_max" in plan
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan


def test_route_counts_aggregates_before_python(spark, sf_dir):
    plan = _plan(registry.QUERIES["route_counts"](spark, sf_dir))
    # the name-cleaning UDF sits above the per-type partial count
    assert plan.index("ArrowEvalPython") < plan.index("partial_count")


def test_paged_scan_is_parallel(spark, sf_dir):
    df = registry.QUERIES["paged_scan"](spark, sf_dir)
    assert df.rdd.getNumPartitions() >= 1
    n = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert df.count() == n


def test_scan_partition_tags_are_disjoint_and_complete(spark, sf_dir):
    df = registry.QUERIES["jdbc_scan_partitioned"](spark, sf_dir)
    assert df.where("scan_part IS NULL").count() == 0
    assert df.select("scan_part").distinct().count() >= 1


def test_anti_join_at_scale_has_one_exchange_per_side(spark, sf_dir):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = registry.QUERIES["delete_by_keys"](spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()
        final = qe.executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in final and "LeftAnti" in final
        assert final.count("Exchange hashpartitioning") == 2  # the distinct's partitioning is reused
        assert "partial" not in final or "HashAggregate" in final
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
