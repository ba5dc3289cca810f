"""Stored layouts: areas pruned by a batch, buckets joined without exchange."""

import pytest
from pyspark.sql import functions as F

from relayplan.operators import expand as X
from relayplan.operators import rename as N
from relayplan.operators import resolve as R
from relayplan.session import scratch_path
from relayplan.sources import layout as L
from relayplan.sources.tables import Tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def executed(df):
    """The final plan of a collected DataFrame, its stages opened."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        out.append(node)
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def files_read(df, part):
    scans = [n for n in executed(df) if n.getClass().getSimpleName() == "FileSourceScanExec" and part in n.toString()]
    return sum(n.metrics().get("numFiles").get().value() for n in scans)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_folder_and_what_lies_below_share_an_area(spark):
    paths = ["/", "/a", "/a/", "/a/b", "/a/b/", "/a/b/c", "/a/b/c/", "/a/b/c/d/e.txt", "/a/x/", "/a/b.d/f", "/Ä b/ü/ß"]
    df = spark.createDataFrame([(p,) for p in paths], "path string").select(
        "path", L.path_area(F.col("path")).alias("area"), L.lookup_areas(F.col("path")).alias("looked"))
    got = {r.path: (r.area, r.looked) for r in df.collect()}
    for p, (area, looked) in got.items():
        assert area in looked
        if p.endswith("/"):
            assert all(a in looked for q, (a, _) in got.items() if q.startswith(p))
    assert len(got["/"][1]) == len(got["/a/"][1]) == L.AREAS and len(got["/a/b/"][1]) == 1


def test_a_small_batch_reads_few_areas(spark, sf_small):
    """Lookups and expansions of a batch on the pruned inventory are those on
    the whole; the files read follow the batch."""
    t = Tables(spark, sf_small)
    path = scratch_path(spark, "areas")
    L.write_areas(t.inventory, path)
    stored = L.read_areas(spark, path)
    assert rows(stored.select("project_id", "path")) == rows(t.inventory.select("project_id", "path"))
    few = t.request_sources.filter("source_uri like 'icav2://prj-3/%/'").orderBy("request_id").limit(5)
    batch = spark.createDataFrame(few.collect(), few.schema)
    inv = L.prune(stored, L.touched_areas(L.project_paths(batch, "source_uri")))
    want, got = R.resolve_sources(batch, t.inventory), R.resolve_sources(batch, inv)
    assert rows(got) == rows(want) and len(rows(want)) == 5
    assert rows(X.expand_recursive(got, t.requests, inv)) == rows(X.expand_recursive(want, t.requests, t.inventory)) != []
    one, whole = inv.select("path"), stored.select("path")
    one.collect(), whole.collect()
    assert "dynamicpruning" in one._jdf.queryExecution().optimizedPlan().toString()
    name = path.rsplit("/", 1)[-1]
    assert 0 < files_read(one, name) <= files_read(whole, name) / 8


def test_nothing_touched_reads_nothing(spark, sf_small):
    t = Tables(spark, sf_small)
    path = scratch_path(spark, "areas")
    L.write_areas(t.inventory, path)
    none = spark.createDataFrame([("gs://b/k",), (None,), ("icav2://",)], "u string")
    pruned = L.prune(L.read_areas(spark, path), L.touched_areas(L.project_paths(none, "u")))
    assert pruned.count() == 0


@pytest.mark.parametrize("by", [("project_id", "path"), ("data_id",)])
def test_bucketed_lookup_exchanges_the_keys_only(spark, sf_small, no_broadcast, by):
    t = Tables(spark, sf_small)
    path = scratch_path(spark, "buckets")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    n = L.write_buckets(t.inventory, table, path, by)
    schema = spark.table(table).schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    inv = L.open_buckets(spark, table, path, schema, by, n)

    def look(inventory):
        if by == ("data_id",):
            refs = t.renaming_map.filter("data_id is not null").select("request_id", "item", "data_id")
            return R.lookup_by_id(refs, inventory)
        return R.resolve_sources(t.request_sources, inventory)

    got = look(inv)
    assert rows(got) == rows(look(t.inventory)) != []
    scans = [x for x in executed(got) if x.getClass().getSimpleName() == "FileSourceScanExec" and table in x.toString()]
    assert len(scans) == 1
    for x in executed(got):
        if "Exchange" in x.getClass().getSimpleName():
            assert table not in x.toString()


def test_stored_tables_are_scanned_and_not_derived_again(spark, sf_small):
    t = Tables(spark, sf_small)
    stored = t.stored("files")
    assert rows(stored.files) == rows(t.files)
    assert not any("lineitem" in f for f in stored.inventory.inputFiles())
    assert any("lineitem" in f for f in t.inventory.inputFiles())


def test_items_with_their_objects(spark):
    items = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, "s3://b/c"), (1, 3, "x", None), (1, 4, "fold", None),
                                   (2, 1, "a", None)], "request_id long, item int, data_id string, input_uri string")
    inv = spark.createDataFrame([("a", "FILE", "p", "/r/a.txt", "a.txt", 7), ("fold", "FOLDER", "p", "/r/", "r", None)],
                                "data_id string, data_type string, owning_project_id string, path string, name string, size long")
    got = {(r.request_id, r.item): (r.obj_project, r.obj_path, r.obj_name, r.obj_size)
           for r in N.item_objects(items, inv).collect()}
    hit, none = ("p", "/r/a.txt", "a.txt", 7), (None,) * 4
    assert got == {(1, 1): hit, (1, 2): none, (1, 3): none, (1, 4): none, (2, 1): hit}


def test_exchanges_grow_with_the_input(spark):
    """More partitions for a large input, the session's own for a small one; a
    number that the session has chosen stays."""
    from relayplan import session as SE
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert SE.size_exchanges(spark, (least + 5) * SE.EXCHANGE_INPUT) == least + 5
        assert spark.range(10).repartition("id").rdd.getNumPartitions() <= least + 5
        assert SE.size_exchanges(spark, 10) == least
        spark.conf.set(SE.INITIAL, "31")
        assert SE.size_exchanges(spark, 1 << 40) == 31
    finally:
        spark.conf.unset(SE.INITIAL)


def test_a_task_does_not_grow_with_the_input(spark):
    """Adaptive execution puts partitions together up to a size of ours, unless the
    session has chosen its own."""
    from relayplan import session as SE
    before = spark.conf.get(SE.ADVISORY, None)
    try:
        spark.conf.unset(SE.ADVISORY)
        SE.size_exchanges(spark, 10)
        assert int(spark.conf.get(SE.ADVISORY)) == SE.EXCHANGE_OUTPUT < 64 << 20
        spark.conf.set(SE.ADVISORY, "17MB")
        SE.size_exchanges(spark, 1 << 40)
        assert spark.conf.get(SE.ADVISORY) == "17MB"
    finally:
        spark.conf.unset(SE.INITIAL)
        spark.conf.unset(SE.ADVISORY) if before is None else spark.conf.set(SE.ADVISORY, before)


@pytest.mark.parametrize("name", ["transfer_action", "recursive_jobs", "verify_pair", "touched_inventory", "resolve_renames"])
def test_plans_derive_files_once(spark, sf_small, name):
    """The result reads stored files and sources; it derives neither again."""
    from relayplan import plans
    read = plans.QUERIES[name](spark, sf_small).inputFiles()
    assert not any("lineitem" in f for f in read) and any("stored-" in f for f in read)


def test_touched_objects_of_odd_paths(spark, tmp_path):
    """Only ancestors as deep as a named folder are met; a named file, and objects of a
    project with no named folder, are still found."""
    from relayplan.functions import uri as U
    named = spark.createDataFrame([("p", "/a/b/"), ("p", "/a/b/"), ("q", "/x.txt"), ("p", "/"), (None, "/a/")],
                                  "project_id string, path string")
    levels = {r.project_id: sorted(r._levels) for r in X.folder_levels(named.filter(F.col("path").endswith("/"))).collect()}
    assert levels == {"p": [1, 3], None: [2]}
    got = spark.createDataFrame([("/a/b/c/d.txt",), ("/a/b/",), ("/",), ("a/b/c",), ("/a//b",), (None,)], "path string").select(
        "path", U.ancestors("path", F.array(F.lit(1), F.lit(3), F.lit(9))).alias("some"), U.ancestors("path").alias("all"))
    assert {r.path: (r.some, r.all) for r in got.collect()} == {
        "/a/b/c/d.txt": (["/", "/a/b/"], ["/", "/a/", "/a/b/", "/a/b/c/"]), "/a/b/": (["/"], ["/", "/a/"]),
        "/": ([], []), "a/b/c": (["a/"], ["a/", "a/b/"]), "/a//b": (["/", "/a//"], ["/", "/a/", "/a//"]), None: ([], [])}
