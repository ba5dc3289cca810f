"""A folder that owns a third of all files: the expansion join is split by
AQE's skew handling, and salting gives the same rows."""

from pyspark.sql import functions as F

from relayplan.operators import expand as X
from relayplan.operators import resolve as R

CONFS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def skewed_inventory(spark, n=60_000):
    """One project; a third of the files under /hot/, the rest spread over
    2,000 small folders."""
    ids = spark.range(n)
    folder = F.when(F.col("id") % 3 == 0, F.lit("/hot/")).otherwise(
        F.concat(F.lit("/cold/f"), (F.col("id") % 2000).cast("string"), F.lit("/")))
    files = ids.select(F.lit("p").alias("project_id"), F.concat(F.lit("fil."), F.col("id").cast("string")).alias("data_id"),
                       F.lit("FILE").alias("data_type"),
                       F.concat(folder, F.lit("x"), F.col("id").cast("string"), F.lit(".dat")).alias("path"),
                       F.lit("x.dat").alias("name"), F.col("id").alias("size"), F.lit("e").alias("etag"),
                       F.lit("AVAILABLE").alias("status"), F.lit("p").alias("owning_project_id"))
    folders = (files.select(F.regexp_replace("path", "[^/]+$", "").alias("path")).distinct()
                    .select(F.lit("p").alias("project_id"), F.concat(F.lit("fol"), F.col("path")).alias("data_id"),
                            F.lit("FOLDER").alias("data_type"), "path",
                            F.regexp_extract("path", "([^/]+)/$", 1).alias("name"), F.lit(None).cast("long").alias("size"),
                            F.lit(None).cast("string").alias("etag"), F.lit("AVAILABLE").alias("status"),
                            F.lit("p").alias("owning_project_id")))
    return files.unionByName(folders)


def test_hot_folder_is_split_and_salting_agrees(spark):
    old = {k: spark.conf.get(k, None) for k in CONFS}
    for k, v in CONFS.items():
        spark.conf.set(k, v)
    try:
        inventory = skewed_inventory(spark)
        sources = spark.createDataFrame(
            [(1, 0, "icav2://p/hot/")] + [(2 + i, 0, f"icav2://p/cold/f{i}/") for i in range(200)],
            "request_id long, pos int, source_uri string")
        rq = sources.select("request_id", F.lit("icav2://d/out/").alias("destination_uri"))
        resolved = R.resolve_sources(sources, inventory)
        plain = X.expand_recursive(resolved, rq, inventory).select("request_id", "data_id", "dest_path")
        rows = plain.collect()
        plan = plain._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in plan or "skew=true" in plan
        assert sum(1 for r in rows if r.request_id == 1) == 20_000
        salted = X.expand_recursive(resolved, rq, inventory, salt=8) \
            .select("request_id", "data_id", "dest_path")
        assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, rows))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
