"""Operator behaviour on hand-made rows, branch counts and invariants."""

from pyspark.sql import functions as F

from relayplan.operators import actions as A
from relayplan.operators import expand as X
from relayplan.operators import jobs as J
from relayplan.operators import rename as N
from relayplan.operators import resolve as R
from relayplan.sources.tables import Tables

INV_SCHEMA = ("project_id string, data_id string, data_type string, path string, name string, size long, "
              "etag string, status string, owning_project_id string")


def inv(spark, rows):
    full = [(p, i, t, path, path.rstrip("/").rsplit("/", 1)[-1], s, e, "AVAILABLE", p) for p, i, t, path, s, e in rows]
    return spark.createDataFrame(full, INV_SCHEMA)


def reqs(spark, rows):
    return spark.createDataFrame(rows, "request_id long, destination_uri string, project_id string, src_folder string")


def test_golden_folder_expansion(spark):
    """Two source folders -> one job per folder at dest/<folder name>/."""
    inventory = inv(spark, [
        ("src-prj", "fol.s", "FOLDER", "/analyses/run1/output/Samples/", None, None),
        ("src-prj", "fol.r", "FOLDER", "/analyses/run1/output/Reports/", None, None),
        ("src-prj", "fol.d", "FOLDER", "/analyses/run1/output/Samples/deep/", None, None),
        ("src-prj", "fil.1", "FILE", "/analyses/run1/output/Samples/s1.bam", 10, "a"),
        ("src-prj", "fil.2", "FILE", "/analyses/run1/output/Samples/deep/s2.bam", 20, "b"),
        ("src-prj", "fil.3", "FILE", "/analyses/run1/output/Reports/r.html", 5, "c"),
        ("src-prj", "fil.4", "FILE", "/analyses/run1/output/other.txt", 1, "d"),
    ])
    sources = spark.createDataFrame([(1, 0, "icav2://src-prj/analyses/run1/output/Samples/"),
                                     (1, 1, "icav2://src-prj/analyses/run1/output/Reports/")],
                                    "request_id long, pos int, source_uri string")
    rq = reqs(spark, [(1, "icav2://dst-prj/primary/batch7/", "src-prj", "/")])
    resolved = R.resolve_sources(sources, inventory)
    assert sorted(r.kind for r in resolved.collect()) == ["FOLDER", "FOLDER"]
    ex = X.expand_recursive(resolved, rq, inventory)
    got = sorted((r.data_id, r.dest_path) for r in ex.collect())
    assert got == [("fil.1", "/primary/batch7/Samples/s1.bam"),
                   ("fil.2", "/primary/batch7/Samples/deep/s2.bam"),
                   ("fil.3", "/primary/batch7/Reports/r.html")]
    tree = X.folder_tree(resolved, rq, inventory)
    jobs = sorted((r.dest_folder, r.files) for r in X.recursive_jobs(tree, ex).collect())
    assert jobs == [("/primary/batch7/Reports/", 1), ("/primary/batch7/Samples/", 1),
                    ("/primary/batch7/Samples/deep/", 1)]


def test_prefix_versus_path_match(spark):
    items = spark.createDataFrame([(1, 1, "icav2://p/run10/f", None, "x")],
                                  "request_id long, item int, input_uri string, data_id string, output_file_name string")
    sources = spark.createDataFrame([(1, 0, "icav2://p/run1")], "request_id long, pos int, source_uri string")
    ext = spark.createDataFrame([], "request_id long, pos int, uri string")
    assert N.prefix_matches(items, sources, ext, "prefix").count() == 1   # bare startswith matches
    assert N.prefix_matches(items, sources, ext, "path").count() == 0     # path containment does not
    sources2 = spark.createDataFrame([(1, 0, "icav2://p/run10")], "request_id long, pos int, source_uri string")
    assert N.prefix_matches(items, sources2, ext, "path").count() == 1


def test_destination_collision_and_loop_guard(spark):
    planned = spark.createDataFrame([(1, "d", "/x/a.txt"), (1, "d", "/x/a.txt"), (1, "d", "/x/b.txt"),
                                     (2, "d", "/x/a.txt")], "request_id long, target_project string, target_path string")
    c = A.destination_collisions(planned).collect()
    assert [(r.request_id, r.dest_path, r.n) for r in c] == [(1, "/x/a.txt", 2)]
    resolved = spark.createDataFrame(
        [(1, 0, "icav2://p/data/", "FOLDER", "p", "fol.1", "/data/", "data", None, None),
         (2, 0, "icav2://p/data/", "FOLDER", "p", "fol.1", "/data/", "data", None, None),
         (3, 0, "icav2://p/data/", "FOLDER", "p", "fol.1", "/data/", "data", None, None)],
        "request_id long, pos int, source_uri string, kind string, project_id string, data_id string, "
        "path string, name string, size long, etag string")
    rq = reqs(spark, [(1, "icav2://p/data/copy/", "p", "/"), (2, "icav2://q/data/copy/", "p", "/"),
                      (3, "icav2://p/data/", "p", "/")])
    got = sorted(r.request_id for r in X.loop_guard(resolved, rq).collect())
    assert got == [1, 3]          # other project is fine; the folder itself is a loop


def test_branch_counts_sf0001(spark, sf_small):
    t = Tables(spark, sf_small)
    resolved = R.resolve_sources(t.request_sources, t.inventory)
    kinds = dict(resolved.groupBy("kind").count().collect())
    assert kinds == {"FILE": 1809, "FOLDER": 892, "EXTERNAL": 338}
    actions = A.transfer_action(A.file_targets(resolved, t.requests), t.destination_inventory)
    assert dict(actions.groupBy("action").count().collect()) == \
        {"COPY": 1040, "REPLACE_PARTIAL": 264, "SKIP": 254, "CONFLICT": 251}
    ex = X.expand_recursive(resolved, t.requests, t.inventory)
    agg = ex.agg(F.count("*").alias("n"), F.countDistinct("request_id").alias("r"), F.sum("size").alias("b")).first()
    assert (agg.n, agg.r, agg.b) == (2790, 892, 33_446_952_960)
    st = dict(J.match_status(t.job_status_events, t.job_registry).groupBy("outcome").count().collect())
    assert st == {"SUCCESS": 139, "FAILURE": 262, "NON_TERMINAL": 264, "NOT_IN_DB": 335}
    ft = dict(J.first_terminal(t.job_status_events, t.job_registry).groupBy("status").count().collect())
    assert ft == {"SUCCEEDED": 46, "PARTIALLY_SUCCEEDED": 37, "FAILED": 50}


def test_invariants(spark, sf_small):
    t = Tables(spark, sf_small)
    resolved = R.resolve_sources(t.request_sources, t.inventory)
    # every source gets exactly one class
    assert resolved.count() == t.request_sources.count()
    assert resolved.select("request_id", "pos").distinct().count() == resolved.count()
    # each planned file exactly one action
    targets = A.file_targets(resolved, t.requests)
    actions = A.transfer_action(targets, t.destination_inventory)
    assert actions.count() == targets.count()


def test_expansion_equals_recursive_cte(spark, sf_small):
    """Ancestor equi-join = fixpoint over the parent relation."""
    t = Tables(spark, sf_small)
    resolved = R.resolve_sources(t.request_sources, t.inventory)
    ex = X.expand_recursive(resolved, t.requests, t.inventory).select("request_id", "data_id")
    resolved.filter("kind = 'FOLDER'").createOrReplaceTempView("t_src_folders")
    t.inventory.createOrReplaceTempView("t_inventory")
    rec = spark.sql("""
      WITH RECURSIVE walk(request_id, project_id, path) AS (
        SELECT request_id, project_id, path FROM t_src_folders
        UNION ALL
        SELECT w.request_id, i.project_id, i.path FROM walk w JOIN t_inventory i
          ON i.project_id = w.project_id AND i.data_type = 'FOLDER'
         AND regexp_replace(i.path, '[^/]+/?$', '') = w.path)
      SELECT w.request_id, i.data_id FROM walk w JOIN t_inventory i
        ON i.project_id = w.project_id AND i.data_type = 'FILE'
       AND regexp_replace(i.path, '[^/]+/?$', '') = w.path""")
    assert sorted(map(tuple, ex.collect())) == sorted(map(tuple, rec.collect()))


def test_registry_ops(spark):
    reg = spark.createDataFrame([("j1", "JOB_ID", "t1", "2024-01-01 00:00:00"), ("j2", "JOB_ID", "t2", "2024-01-01 00:00:00"),
                                 ("j3", "OTHER", "t3", "2024-01-01 00:00:00")],
                                "id string, id_type string, task_token string, registered_at string") \
        .withColumn("registered_at", F.to_timestamp_ntz("registered_at"))
    new = spark.createDataFrame([("j1", "JOB_ID", "t1b", "2024-01-01 01:00:00")],
                                "id string, id_type string, task_token string, registered_at string") \
        .withColumn("registered_at", F.to_timestamp_ntz("registered_at"))
    up = {r.id: r.task_token for r in J.upsert_registry(reg, new).collect()}
    assert up == {"j1": "t1b", "j2": "t2", "j3": "t3"}
    done = spark.createDataFrame([("j2",), ("j3",)], "job_id string")
    left = sorted(r.id for r in J.delete_registry(reg, done).collect())
    assert left == ["j1", "j3"]          # OTHER rows are not job ids
    assert dict(J.pending_count(reg).collect()) == {"JOB_ID": 2, "OTHER": 1}


def test_salted_expansion_is_identical(spark, sf_small):
    t = Tables(spark, sf_small)
    resolved = R.resolve_sources(t.request_sources, t.inventory)
    plain = X.expand_recursive(resolved, t.requests, t.inventory).select("request_id", "data_id", "dest_path")
    salted = X.expand_recursive(resolved, t.requests, t.inventory, salt=7).select("request_id", "data_id", "dest_path")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))


def test_timeouts_split_by_bucket_equal_plain_lag(spark, sf_small):
    """Bucketed lag with boundary stitching = one lag over the whole job."""
    from pyspark.sql import Window
    e = Tables(spark, sf_small).job_status_events
    got = J.heartbeat_timeouts(e, bucket="1 hour").select("job_id", "event_id", "gap_seconds")
    w = Window.partitionBy("job_id").orderBy("ts", "event_id")
    ref = (e.withColumn("p", F.lag("ts").over(w)).filter(F.col("p").isNotNull())
             .withColumn("g", F.expr("timestampdiff(MICROSECOND, p, ts)")).filter("g > 300000000")
             .select("job_id", "event_id", F.floor(F.col("g") / 1000000).alias("gap_seconds")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))
    tiny = J.heartbeat_timeouts(e, bucket="1 minute").select("job_id", "event_id", "gap_seconds")
    assert sorted(map(tuple, tiny.collect())) == sorted(map(tuple, ref.collect()))


def test_long_lists_go_on_in_further_events(spark, sf_small):
    """No row of a request is lost, however long its lists are."""
    from relayplan.operators.validate import validate_requests
    from relayplan.plans.planner import plan_transfers, requests_from_events
    from relayplan.sources import events as EV
    from relayplan.sources.request_events import request_event_bodies
    t = Tables(spark, sf_small)
    whole, cut = (EV.parse_requests(request_event_bodies(t, max_items=n)) for n in (1000, 3))
    assert cut.filter("part > 0").count() > 0
    # item numbers count within an event, and line numbers are no gapless list positions
    bad = [validate_requests(e).filter("rule <> 'minItems'").select("request_id", "rule") for e in (whole, cut)]
    assert bad[0].exceptAll(bad[1]).isEmpty() and bad[1].exceptAll(bad[0]).isEmpty() and bad[0].count() > 0
    a, b = requests_from_events(whole), requests_from_events(cut)
    for x, y in ((a.requests, b.requests), (a.sources.drop("pos"), b.sources.drop("pos")),
                 (a.externals.drop("pos"), b.externals.drop("pos")), (a.renames.drop("item"), b.renames.drop("item"))):
        assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
    totals = [sorted(map(tuple, A.transfer_summary(plan_transfers(
        e.requests, e.sources, t.inventory, t.destination_inventory, t.external_objects).actions).collect()))
        for e in (a, b)]
    assert totals[0] == totals[1]


def test_more_than_ten_thousand_sources(spark, sf_small):
    from relayplan.operators.validate import validate_requests
    from relayplan.plans.planner import requests_from_events
    from relayplan.sources import events as EV
    from relayplan.sources.request_events import request_event_bodies
    t = Tables(spark, sf_small)
    rid = t.requests.filter("request_id % 30 <> 0").first().request_id
    t.__dict__["request_sources"] = spark.range(12_000).select(
        F.lit(rid).alias("request_id"), F.col("id").cast("int").alias("pos"),
        F.concat(F.when(F.col("id") % 2 == 0, F.lit("icav2")).otherwise(F.lit("gs")), F.lit("://p/f"), "id").alias("source_uri"))
    ev = EV.parse_requests(request_event_bodies(t))
    assert requests_from_events(ev).sources.filter(F.col("request_id") == rid).count() == 12_000
    bad = validate_requests(ev).filter((F.col("request_id") == rid) & F.col("field").startswith("Detail.payload.sourceUriList["))
    assert bad.filter("rule = 'pattern'").count() == 6_000


def test_batches_are_full(spark):
    from relayplan.operators import jobs as J
    df = spark.range(0, 1237, 1, 7).select(F.format_string("e-%05d", "id").alias("execution_id"))
    rows = J.batches(df, "execution_id", 50).orderBy("batch_no").collect()
    assert [r.n for r in rows] == [50] * 24 + [37] and rows[3].first_id == "e-00150"
    assert J.batches(df.limit(0), "execution_id").count() == 0


def test_jobs_for_folders_without_files(spark):
    inventory = inv(spark, [("p", "fol.a", "FOLDER", "/a/", None, None), ("p", "fol.b", "FOLDER", "/a/b/", None, None),
                            ("p", "fol.e", "FOLDER", "/a/empty/", None, None), ("p", "fil.1", "FILE", "/a/b/x", 5, "e")])
    sources = spark.createDataFrame([(1, 0, "icav2://p/a/")], "request_id long, pos int, source_uri string")
    rq = reqs(spark, [(1, "icav2://d/out/", "p", "/")])
    resolved = R.resolve_sources(sources, inventory)
    tree = X.folder_tree(resolved, rq, inventory)
    jobs = X.recursive_jobs(tree, X.expand_recursive(resolved, rq, inventory))
    assert sorted(map(tuple, jobs.collect())) == [(1, "/out/a/", 0, 0), (1, "/out/a/b/", 1, 5), (1, "/out/a/empty/", 0, 0)]
    missing = R.missing_destinations(rq, inv(spark, [("d", "f", "FILE", "/out/a/y", 1, "e")]), tree)
    assert sorted(r.path for r in missing.collect()) == ["/out/a/b/", "/out/a/empty/"]


def test_expansion_mixed_depths(spark):
    """Folder sources at different depths of one project."""
    inventory = inv(spark, [
        ("p", "fol.a", "FOLDER", "/a/", None, None),
        ("p", "fol.b", "FOLDER", "/a/b/c/", None, None),
        ("p", "fil.1", "FILE", "/a/x.txt", 1, "e"),
        ("p", "fil.2", "FILE", "/a/b/c/y.txt", 2, "e"),
        ("p", "fil.3", "FILE", "/a/b/c/d/z.txt", 3, "e"),
        ("q", "fil.4", "FILE", "/a/b/c/w.txt", 4, "e"),
    ])
    sources = spark.createDataFrame([(1, 0, "icav2://p/a/"), (2, 0, "icav2://p/a/b/c/")],
                                    "request_id long, pos int, source_uri string")
    rq = reqs(spark, [(1, "icav2://d/out/", "p", "/"), (2, "icav2://d/out2/", "p", "/")])
    resolved = R.resolve_sources(sources, inventory)
    got = sorted((r.request_id, r.data_id, r.dest_path) for r in X.expand_recursive(resolved, rq, inventory).collect())
    assert got == [(1, "fil.1", "/out/a/x.txt"), (1, "fil.2", "/out/a/b/c/y.txt"), (1, "fil.3", "/out/a/b/c/d/z.txt"),
                   (2, "fil.2", "/out2/c/y.txt"), (2, "fil.3", "/out2/c/d/z.txt")]


def test_empty_destination_folder_is_not_missing(spark):
    dest = inv(spark, [("d", "fol.e", "FOLDER", "/empty/", None, None),
                       ("d", "fil.1", "FILE", "/full/x.txt", 1, "e")])
    rq = reqs(spark, [(1, "icav2://d/empty/", "p", "/"), (2, "icav2://d/full/", "p", "/"),
                      (3, "icav2://d/new/", "p", "/"), (4, "icav2://d/new", "p", "/")])
    got = sorted((r.project_id, r.path) for r in R.missing_destinations(rq, dest).collect())
    assert got == [("d", "/new/")]     # request 4 lacks the final '/': a validation error, not a folder


def test_expansion_meets_folders_at_their_levels(spark):
    """With the levels of the sources an expansion has the same rows, of fewer ancestors."""
    inventory = inv(spark, [
        ("p", "fol.a", "FOLDER", "/a/", None, None), ("p", "fol.b", "FOLDER", "/a/b/", None, None),
        ("p", "fol.e", "FOLDER", "/a/b/empty/", None, None), ("q", "fol.q", "FOLDER", "/a/", None, None),
        ("p", "fil.1", "FILE", "/a/1.dat", 1, "e"), ("p", "fil.2", "FILE", "/a/b/c/d/2.dat", 2, "e"),
        ("q", "fil.3", "FILE", "/a/b/3.dat", 3, "e"), (None, "fil.4", "FILE", "/a/b/4.dat", 4, "e")])
    sources = spark.createDataFrame([(1, 0, "icav2://p/a/b/"), (2, 0, "icav2://p/a/"), (2, 1, "icav2://p/a/b/"),
                                     (3, 0, "icav2://p/a/1.dat"), (4, 0, "icav2://r/a/")],
                                    "request_id long, pos int, source_uri string")
    rq = reqs(spark, [(i, "icav2://dst/x/", "p", "/") for i in (1, 2, 3, 4)])
    resolved = R.resolve_sources(sources, inventory)
    levels = X.source_levels(resolved)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    want = rows(X.expand_recursive(resolved, rq, inventory))
    assert len(want) == 4 and rows(X.expand_recursive(resolved, rq, inventory, levels=levels)) == want
    assert rows(X.expand_recursive(resolved, rq, inventory, salt=3, levels=levels)) == want
    assert rows(X.folder_tree(resolved, rq, inventory, levels)) == rows(X.folder_tree(resolved, rq, inventory)) != []
    assert X.file_ancestors(inventory, levels).count() == 3 < X.file_ancestors(inventory).count() == 13


def test_size_lookup_joins_once(spark):
    """Project and external sizes come from one join; repeated objects repeat a check,
    and odd URIs find nothing."""
    from relayplan.operators import verify as V
    objects = spark.createDataFrame([("p", "/a", "FILE", 1), ("p", "/twice", "FILE", 2), ("p", "/twice", "FILE", 2),
                                     ("p", "/fold", "FOLDER", None), ("p", "/null", "FILE", None), (None, "/a", "FILE", 9),
                                     ("", "s3://b/k", "FILE", 8)],
                                    "project_id string, path string, data_type string, size long")
    ext = spark.createDataFrame([(1, "s3://b/k", 5, True), (2, "s3://b/k", 6, True), (3, "s3://b/old", 7, False),
                                 (4, None, 1, True), (5, "icav2://p/a", 3, True)],
                                "s3_object_id long, uri string, size long, current_state boolean").selectExpr(
        "*", "'e' etag", "'b' bucket", "'k' key")
    uris = ["icav2://p/a", "icav2://p/twice", "icav2://p/fold", "icav2://p/null", "s3://b/k", "s3://b/old", "gs://p/a",
            "icav2://p", "", None]
    checks = spark.createDataFrame([(i, u) for i, u in enumerate(uris)], "id long, u string")
    j = V.size_lookup(checks, "u", "n", objects, ext)
    assert j.columns == ["id", "u", "n", "n_found"]
    assert sorted((r.id, r.n, r.n_found) for r in j.collect()) == [
        (0, 1, True), (1, 2, True), (1, 2, True), (2, None, False), (3, None, True), (4, 5, True), (5, None, False),
        (6, None, False), (7, None, False), (8, None, False), (9, None, False)]
    assert j._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_part_split_lists_every_id(spark):
    """A-3: the lists are whole: a long one goes on in further rows, a row of a
    request without id counts as a file, equal ids stay."""
    files = [(1, f"m{i:03d}", "a-2", 10) for i in range(25)] + [(1, "s1", "a", 1), (1, "s1", "b", 2), (1, "u", None, 5)]
    files += [(2, None, "a", 7), (3, "x", "c-1", None), (None, "n2", "a", 1), (None, "n1", "a", 1)]
    df = spark.createDataFrame(files, "request_id long, data_id string, etag string, size long")
    got = {(r.request_id, r.part_class, r.part): (r.files, r.bytes, r.first_id, r.last_id, r.ids)
           for r in A.split_parts(df, max_items=10).collect()}
    lines = lambda a, b: "\n".join(f"m{i:03d}" for i in range(a, b))
    assert got == {
        (1, "MULTI", 0): (25, 250, "m000", "m024", lines(0, 10)), (1, "MULTI", 1): (25, 250, "m000", "m024", lines(10, 20)),
        (1, "MULTI", 2): (25, 250, "m000", "m024", lines(20, 25)), (1, "SINGLE", 0): (2, 3, "s1", "s1", "s1\ns1"),
        (1, "UNKNOWN", 0): (1, 5, "u", "u", "u"), (2, "SINGLE", 0): (1, 7, None, None, None),
        (3, "MULTI", 0): (1, None, "x", "x", "x"), (None, "SINGLE", 0): (2, 2, "n1", "n2", "n1\nn2")}
    # whatever the partitions of a list
    many = A.split_parts(df.repartition(7), max_items=1).collect()
    assert len(many) == len(files) and sorted(r.ids for r in many if r.part_class == "MULTI") == [
        *(f"m{i:03d}" for i in range(25)), "x"]
