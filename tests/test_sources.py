"""Loaders, sinks and the registry writer."""

import json
import os

from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.operators import plan as PL
from relayplan.operators import verify as V
from relayplan.session import scratch_path
from relayplan.sources import catalog as C
from relayplan.sources import events as EV
from relayplan.sources.tables import Tables


def test_read_requests_from_json_file(spark, tmp_path):
    good = {"EventBusName": K.EVENT_BUS_NAME, "Source": "manual", "DetailType": K.DETAIL_TYPE,
            "Detail": {"payload": {"sourceUriList": ["icav2://p/a/"], "destinationUri": "icav2://q/b/"},
                       "taskToken": "tok"}}
    legacy = {"EventBusName": K.EVENT_BUS_NAME, "Source": "manual", "DetailType": K.DETAIL_TYPE,
              "Detail": {"sourceUriList": ["icav2://p/x"], "destinationUri": "icav2://q/y/", "taskToken": "t2"}}
    f = tmp_path / "events.json"
    f.write_text(json.dumps(good) + "\n" + json.dumps(legacy) + "\n{broken\n")
    df = EV.read_requests(spark, str(f)).cache()
    ok, bad = EV.quarantine(df, EV.message_problem())
    assert [r.reason for r in bad.collect()] == ["MALFORMED_JSON"]
    n = EV.normalise_legacy(ok).select("request.payload.destinationUri", "request.layout").collect()
    assert sorted(map(tuple, n)) == [("icav2://q/b/", "nested"), ("icav2://q/y/", "legacy")]
    routes = sorted(r.route for r in EV.route_events(ok).collect())
    assert routes == ["external_copy", "external_legacy"]


def test_inventory_roundtrip_and_pushdown(spark, sf_small):
    t = Tables(spark, sf_small)
    path = scratch_path(spark, "inventory")
    C.write_inventory(t.inventory, path)
    df = C.read_inventory(spark, path, project_ids=["prj-1"], data_type="FILE", cols=["project_id", "path", "size"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "prj-1" in plan
    assert df.count() == t.inventory.filter("project_id = 'prj-1' and data_type = 'FILE'").count()


def test_write_plan_partitioned(spark, sf_small, tmp_path):
    from relayplan.operators import resolve as R
    t = Tables(spark, sf_small)
    r = R.resolve_sources(t.request_sources, t.inventory)
    out = str(tmp_path / "plan")
    PL.write_plan(r, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("kind=")) == ["kind=EXTERNAL", "kind=FILE", "kind=FOLDER"]
    assert spark.read.parquet(out).count() == r.count()


def test_registry_writer_puts_and_replay(spark):
    path = scratch_path(spark, "registry")
    w = C.registry_writer(path)
    b0 = spark.createDataFrame([("j1", "JOB_ID", "a"), ("j2", "JOB_ID", "b")], "id string, id_type string, task_token string") \
        .withColumn("registered_at", F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    b1 = spark.createDataFrame([("j1", "JOB_ID", "a2")], "id string, id_type string, task_token string") \
        .withColumn("registered_at", F.to_timestamp_ntz(F.lit("2024-01-01 01:00:00")))
    w(b0, 0)
    w(b1, 1)
    w(b1, 1)  # replayed batch: same table again
    got = {r.id: r.task_token for r in C.read_registry(spark, path).collect()}
    assert got == {"j1": "a2", "j2": "b"}


def test_verify_transfer_modes(spark, sf_small):
    t = Tables(spark, sf_small)
    objs = t.inventory.select("project_id", "path", "data_type", "size")
    f = t.files.select("project_id", "path", "size").first()
    checks = spark.createDataFrame([
        (1, f.size, f"icav2://{f.project_id}{f.path}", None, None),
        (2, f.size + 1, f"icav2://{f.project_id}{f.path}", None, None),
        (3, None, None, f"icav2://{f.project_id}/nowhere/", f"icav2://{f.project_id}{f.path}"),
        (4, None, None, None, None),
        (5, 10, "gs://b/k", None, None),
    ], "check_id int, file_size long, output_uri string, destination_uri string, source_uri string")
    got = {r.check_id: (r.mode, r.result) for r in V.verify_transfer(checks, objs, t.external_objects).collect()}
    assert got == {1: ("SIZE", "OK"), 2: ("SIZE", "MISMATCH"), 3: ("PAIR", "MISSING"), 4: ("INVALID", "INVALID"),
                   5: ("SIZE", "UNSUPPORTED")}


def test_bloom_filter_prunes_stored_inventory(spark, sf_small):
    """With a stored inventory large enough (threshold lowered here), Spark
    prunes the inventory scan with a runtime bloom filter of the source keys."""
    from relayplan.operators import resolve as R
    t = Tables(spark, sf_small)
    path = scratch_path(spark, "inv-bloom")
    C.write_inventory(t.inventory, path)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1KB")
    try:
        r = R.resolve_sources(t.request_sources.filter("request_id % 7 = 0"), C.read_inventory(spark, path))
        assert "might_contain" in r._jdf.queryExecution().optimizedPlan().toString()
        assert r.count() == t.request_sources.filter("request_id % 7 = 0").count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_size_for_input_only_fills_unset(spark):
    from relayplan.session import size_for_input
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        applied = size_for_input(spark, 100 * (1 << 40))
        assert "spark.sql.shuffle.partitions" not in applied          # set by the test session
        assert int(applied["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_package_is_shipped_once(spark):
    import zipfile

    from pyspark import SparkFiles

    from relayplan.session import ship_package
    ship_package(spark)
    ship_package(spark)           # once per application
    files = [str(f) for f in spark.sparkContext.listFiles if "relayplan-" in str(f)]
    assert len(files) == 1
    with zipfile.ZipFile(SparkFiles.get(files[0].rsplit("/", 1)[-1])) as z:
        assert "relayplan/streaming/streams.py" in z.namelist()


def test_scratch_is_cleaned(spark):
    from relayplan import session as SE
    other = SE._SCRATCH.pop(spark.sparkContext.applicationId, [])  # of other tests
    try:
        path, unused = SE.scratch_path(spark, "x"), SE.scratch_path(spark, "y")
        spark.range(3).write.parquet(path)
        assert SE.path_exists(spark, path) and not SE.path_exists(spark, unused)
        assert SE.clean_scratch(spark) == 1 and not SE.path_exists(spark, path)
        assert SE.clean_scratch(spark) == 0
    finally:
        SE._SCRATCH[spark.sparkContext.applicationId] = other


def test_verify_transfer_reads_its_checks_once(spark, sf_small):
    """Every mode goes through the same lookups; checks are not built for each."""
    t = Tables(spark, sf_small)
    checks = spark.read.parquet(f"{sf_small}/customer.parquet").selectExpr(
        "c_custkey as check_id", "cast(c_custkey as long) as file_size", "concat('icav2://p/', c_name) as output_uri",
        "c_name as destination_uri", "c_name as source_uri")
    plan = V.verify_transfer(checks, t.files, t.external_objects)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("c_custkey#") and plan.count("Relation [c_custkey") == 1
