"""What steps leave on disk: exchange files and stored tables that nothing reads any more."""

import time

from pyspark.sql import functions as F

from relayplan import session
from relayplan.operators import expand as X
from relayplan.plans import QUERIES, q_planning
from relayplan.sources.tables import Tables


def exchange_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def gone(spark, before, seconds=20):
    """Waits until the exchange files that came since are removed; those left."""
    until = time.time() + seconds
    while (left := exchange_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_a_stored_step_leaves_no_exchange_files(spark):
    before = exchange_files(spark)
    was = spark.conf.get(session.RELEASE, None)
    df = session.stored(spark.range(20_000).groupBy((F.col("id") % 5_000).alias("k")).agg(F.count("id").alias("n")))
    assert not gone(spark, before)
    assert spark.conf.get(session.RELEASE, None) == was
    assert df.agg(F.sum("n")).first()[0] == 20_000


def test_replaced_tables_are_deleted(spark):
    a = session.stored(spark.range(10))
    b = session.stored(a.filter("id > 4"), a, spark.range(3))
    assert not session.path_exists(spark, a.stored_path) and b.count() == 5


def test_a_plan_keeps_what_its_result_reads(spark, sf_small):
    """transfer_summary: the rows that files are made of and the planned files; not
    the resolved sources, and no text of a file but its place."""
    known = len(session._SCRATCH.get(spark.sparkContext.applicationId, []))
    rows = QUERIES["transfer_summary"](spark, sf_small).collect()
    left = [p for p in session._SCRATCH[spark.sparkContext.applicationId][known:] if session.path_exists(spark, p)]
    columns = sorted(sorted(spark.read.parquet(p).columns) for p in left)
    assert columns == sorted([sorted(q_planning.ACTION),
                              ["l_linenumber", "l_orderkey", "o_orderdate", "q", "rf_code"]])
    assert sum(r.files for r in rows) > 0


def test_folder_contents_are_exchanged_once(spark):
    """The files below a folder meet the folder that knows its destination already:
    files, folders, and requests with folders: four exchanges, none above the files' join."""
    inv = spark.createDataFrame([("p", f"f{i}", "FILE", f"/a/b/{i}", str(i), i, None) for i in range(9)],
                                "project_id string, data_id string, data_type string, path string, name string, size long, etag string")
    src = spark.createDataFrame([(1, "FOLDER", "p", "/a/b/", "b")],
                                "request_id long, kind string, project_id string, path string, name string")
    rq = spark.createDataFrame([(1, "icav2://d/to/")], "request_id long, destination_uri string")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = X.expand_recursive(src, rq, inv)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plan.count("Exchange hashpartitioning(") == 4
    top = plan[:plan.index("Exchange hashpartitioning(")]
    assert top.count("Join") == 1
    assert [(r.data_id, r.dest_path) for r in df.orderBy("data_id").collect()][0] == ("f0", "/to/b/0")


def test_file_rows_are_a_fraction_of_files(spark, sf_small):
    size = lambda df: session.stored_bytes(spark, session.stored(df).stored_path)
    t = Tables(spark, sf_small)
    assert size(t.file_rows) * 3 < size(t.files)
    same = t.stored("file_rows").files
    assert same.columns == t.files.columns and same.exceptAll(t.files).isEmpty() and same.count() == t.files.count() > 0


def test_event_lists_of_odd_requests(spark):
    """A request that comes twice, one without lists, lists that start late or go on,
    items without a position, and lists of requests that are not there."""
    from relayplan.sources.request_events import event_lists
    t = Tables.__new__(Tables)
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    t.__dict__.update(
        requests=frame([(1,), (1,), (2,), (3,)], "request_id long"),
        request_sources=frame([(1, 5, "e"), (1, 0, "a"), (1, 0, "a"), (3, 2, "c"), (3, None, "n"), (9, 0, "x")],
                              "request_id long, pos int, source_uri string"),
        renaming_map=frame([(1, 1, "u", None, "o"), (3, None, None, "d", "p")],
                           "request_id long, item int, input_uri string, data_id string, output_file_name string"),
        external_sources=frame([(1, 0, None)], "request_id long, pos int, uri string"))
    got = sorted(((r.request_id, r.part, r._s and [x.source_uri for x in r._s], r._r and [x.item for x in r._r], r._x)
                  for r in event_lists(t, 2).collect()), key=str)
    one = (1, 0, ["a", "a"], [1], [])
    assert got == sorted([one, one, (1, 2, ["e"], None, None), (2, 0, None, None, None), (3, 0, None, None, None),
                          (3, 1, ["c"], None, None), (3, None, ["n"], None, None), (3, None, None, [None], None),
                          (9, 0, ["x"], None, None)], key=str)


def test_micro_batches_exchange_their_requests_only(spark, sf_small):
    from relayplan.sources.request_events import request_event_bodies, stored_lists
    t = Tables(spark, sf_small)
    lists = stored_lists(t)
    some = t.requests.filter("request_id % 5 = 0")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = request_event_bodies(t, requests=some, lists=lists)
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "lineitem" not in plan and plan.count("Exchange") == plan.count("Exchange hashpartitioning(request_id") == 1
    want = request_event_bodies(t, requests=some)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 0


def test_streams_keep_only_their_outputs(spark, sf_small):
    """stream_validate_requests: lists and the rows of files go when the stream ends."""
    from relayplan.streaming import streams as S
    spark_was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    known = len(session._SCRATCH.get(spark.sparkContext.applicationId, []))
    try:
        assert S.stream_validate_requests(spark, sf_small).count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", spark_was)
    left = [p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in session._SCRATCH[spark.sparkContext.applicationId][known:]
            if session.path_exists(spark, p)]
    assert "stored" not in left and "lists" not in left and "validate-out" in left


def test_lookups_in_steps_find_the_same(spark):
    """Rows without a URI, of another scheme, found twice, in the catalog: the same with
    and without stored steps; what can meet nothing is not exchanged."""
    from relayplan.operators import verify as V
    objects = spark.createDataFrame([("p", "/a", "FILE", 1), ("p", "/a", "FILE", 2), ("p", "/d/a", "FILE", 1), ("p", "/f/", "FOLDER", None)],
                                    "project_id string, path string, data_type string, size long")
    ext = spark.createDataFrame([(1, "s3://b/k", "b", "k", 5, "e", True)],
                                "s3_object_id long, uri string, bucket string, key string, size long, etag string, current_state boolean")
    uris = ["icav2://p/a", "icav2://p/none", "s3://b/k", "gs://p/a", "bad", "", None, None]
    checks = spark.createDataFrame([(i, i, u, "icav2://p/d/", u) for i, u in enumerate(uris)],
                                   "check_id long, file_size long, output_uri string, destination_uri string, source_uri string")
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    for f in (V.verify_transfer, V.verify_pair):
        c = checks.withColumn("file_size", F.when(F.col("check_id") % 2 == 0, F.col("file_size")))
        want = rows(f(c, objects, ext))
        assert rows(f(c, objects, ext, store=session.stored)) == want and len(want) > len(uris)
    seen = []
    V.size_lookup(checks, "output_uri", "size", objects, ext, lambda df: seen.append(df) or df)
    assert len(seen) == 1


def test_uri_sizes_of_odd_items(spark):
    """Items by URI, by id, with both or neither; a place that is there twice; an object
    whose URI is a project's."""
    from relayplan.operators import rename as N
    inv = spark.createDataFrame([("p", "/a", "FILE", 1), ("p", "/a", "FILE", 2), ("p", "/f/", "FOLDER", 9)],
                                "project_id string, path string, data_type string, size long")
    ext = spark.createDataFrame([(1, "s3://b/k", "b", "k", 5, "e", True), (2, "icav2://p/a", "b", "k", 6, "e", True),
                                 (3, "s3://b/old", "b", "old", 7, "e", False)],
                                "s3_object_id long, uri string, bucket string, key string, size long, etag string, current_state boolean")
    items = spark.createDataFrame([(1, 1, "icav2://p/a"), (1, 2, "s3://b/k"), (1, 3, None), (1, 4, "icav2://p/f/"),
                                   (1, 5, "s3://b/old"), (1, 6, "")], "request_id long, item int, input_uri string")
    got = sorted(((r.item, r.uri_size_inv, r.uri_size_ext) for r in N.uri_sizes(items, inv, ext).collect()), key=str)
    assert got == [(1, 1, 6), (1, 2, 6), (2, None, 5), (3, None, None), (4, None, None), (5, None, None), (6, None, None)]


def test_long_plans_keep_only_their_last_step(spark, sf_small):
    for name, kept in (("verify_pair", 2), ("verify_transfer", 2), ("touched_inventory", 1), ("resolve_renames", 3),
                       ("rename_plan", 2), ("event_transfer_summary", 2)):
        known = len(session._SCRATCH.get(spark.sparkContext.applicationId, []))
        read = QUERIES[name](spark, sf_small).inputFiles()
        left = {p.rsplit("/", 1)[-1] for p in session._SCRATCH[spark.sparkContext.applicationId][known:]
                if "/stored-" in p and session.path_exists(spark, p)}
        assert {x for x in left if any(x in f for f in read)} and len(left) <= kept, (name, left)
