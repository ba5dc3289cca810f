"""Logical input tables derived from the driver's parquet tables.

Every table is a lazy DataFrame over the given parquet files, so each query's
work grows with the data. Scans select only the columns they need; Catalyst
prunes the parquet ``ReadSchema`` and pushes the simple filters.

Mapping (see FIXTURES.md B): ``requests`` from orders, source-project
``inventory`` from lineitem x orders (+ the folder tree), ``external_objects``
from documents, job-state notifications from events.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.functions import uri as U
from relayplan.session import size_exchanges, stored, stored_bytes

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

#: The tables that the logical ones are derived from.
SOURCES = ("orders", "lineitem", "events", "documents")

_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    """Scan one input table with an explicit schema: the footer schema is read
    once per path and reused, so later scans run no inference job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        schema = _SCHEMAS[path] = spark.read.parquet(path).schema
    df = spark.read.schema(schema).parquet(path)
    return df.select(*cols) if cols else df


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def folder_id(project_id, path) -> F.Column:
    """Deterministic id for a derived folder object."""
    return F.concat(F.lit("fol."), F.substring(F.md5(F.concat(project_id, F.lit(":"), path)), 1, 16))


def requests_from_orders(o: DataFrame) -> DataFrame:
    """Copy requests from order rows (batch or streaming): one per order."""
    ck = F.col("o_custkey")
    ok = F.col("o_orderkey")
    return o.select(
        ok.alias("request_id"),
        (ck % 5).alias("kind"),
        F.concat(F.lit("prj-"), _s(ok % 8)).alias("project_id"),
        F.concat(F.lit("dst-"), _s(ck % 4)).alias("dest_project_id"),
        F.concat(F.lit("/copies/"), _s(ok), F.lit("/")).alias("dest_path"),
        F.concat(F.when(ck % 29 == 0, F.lit("gs")).otherwise(F.lit(K.PROJECT_SCHEME)),
                 F.lit("://dst-"), _s(ck % 4), F.lit("/copies/"), _s(ok),
                 F.when(ck % 23 == 0, F.lit("")).otherwise(F.lit("/"))).alias("destination_uri"),
        F.concat(F.lit("/runs/"), _s(F.year("o_orderdate")), F.lit("/"), _s(ok), F.lit("/")).alias("src_folder"),
        ck.alias("o_custkey"),
        F.col("o_orderdate").alias("requested_at"),
        F.md5(_s(ok)).alias("task_token"),
    )


def job_events_from_events(e: DataFrame) -> DataFrame:
    """Job-state notifications from event rows (batch or streaming): five
    consecutive events per job, status by event type."""
    j = F.floor(F.col("event_id") / 5)
    st = (F.when(F.col("event_type") == "click", F.lit("WAITING_FOR_RESOURCES"))
           .when(F.col("event_type") == "view", F.lit("RUNNING"))
           .when(F.col("event_type") == "signup", F.lit("SUCCEEDED"))
           .when(F.col("event_type") == "purchase", F.lit("PARTIALLY_SUCCEEDED"))
           .otherwise(F.lit("FAILED")))
    return e.select("event_id", F.concat(F.lit("job-"), _s(j)).alias("job_id"), j.alias("j"),
                    "ts", st.alias("status"))


class Tables:
    """The logical tables of one data directory, built lazily and shared
    within a query so that Spark can reuse identical exchanges."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        size_exchanges(spark, sum(stored_bytes(spark, f"{sf_dir.rstrip('/')}/{name}.parquet") for name in SOURCES))

    def raw(self, name: str, cols: list[str] | None = None) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, cols)

    def stored(self, *names: str) -> Tables:
        """These tables with the named ones written once to the shared folder,
        for queries that use them many times: everything derived from them
        reads the stored rows, and a lost executor costs a read, not a join."""
        out = Tables(self.spark, self.sf_dir)
        for name in names:
            out.__dict__[name] = stored(getattr(out, name))
        return out

    # -- requests -------------------------------------------------------------
    @cached_property
    def requests(self) -> DataFrame:
        return requests_from_orders(self.raw("orders", ["o_orderkey", "o_custkey", "o_orderdate"]))

    # -- source-project inventory -------------------------------------------
    @cached_property
    def file_rows(self) -> DataFrame:
        """What each file is made of: a row per (l_orderkey, l_linenumber) with its
        date, flag and quantity. Stored, it takes a tenth of ``files``, whose texts
        and hashes follow from it.

        Joined before aggregating: both sides shuffle once on the order key
        and the aggregation reuses that partitioning.
        """
        li = self.raw("lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"])
        o = self.raw("orders", ["o_orderkey", "o_orderdate"])
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .groupBy("l_orderkey", "l_linenumber", "o_orderdate")
                # the flag is one ASCII character: aggregating its code keeps the
                # buffer fixed-width, so Spark plans a hash aggregate, not a sort
                .agg(F.min(F.ascii("l_returnflag")).alias("rf_code"), F.min("l_quantity").alias("q")))

    @cached_property
    def files(self) -> DataFrame:
        """One FILE object per row of ``file_rows``."""
        return self._files(self.file_rows)

    def _files_of(self, requests: DataFrame) -> DataFrame:
        """``requests`` with the files of their orders: joined as rows of numbers, so
        that no texts of files are exchanged."""
        g = requests.join(self.file_rows, F.col("l_orderkey") == F.col("request_id"))
        return self._files(g, *requests.columns)

    @staticmethod
    def _files(rows: DataFrame, *more: str) -> DataFrame:
        """The objects that ``file_rows`` stand for, with the columns ``more``."""
        g = rows.withColumn("rf", F.chr("rf_code"))
        lk, ln = F.col("l_orderkey"), F.col("l_linenumber")
        key = F.concat(_s(lk), F.lit("."), _s(ln))
        etag = (F.when((lk % 50 == 0) & (ln == 7), F.lit(None).cast("string"))
                 .when(F.col("q") > 16, F.concat(F.md5(key), F.lit("-"), _s(F.ceil(F.col("q") / 16))))
                 .otherwise(F.md5(key)))
        pid = F.concat(F.lit("prj-"), _s(lk % 8))
        return (g.select(
            pid.alias("project_id"),
            F.concat(F.lit("fil."), key).alias("data_id"),
            F.lit(K.FILE).alias("data_type"),
            F.concat(F.lit("/runs/"), _s(F.year("o_orderdate")), F.lit("/"), _s(lk), F.lit("/"),
                     F.col("rf"), F.lit("/L"), _s(ln), F.lit(".dat")).alias("path"),
            F.concat(F.lit("L"), _s(ln), F.lit(".dat")).alias("name"),
            (F.col("q").cast("bigint") * F.lit(524288)).alias("size"),
            etag.alias("etag"),
            F.lit("AVAILABLE").alias("status"),
            pid.alias("owning_project_id"),
            lk.alias("l_orderkey"),
            ln.alias("l_linenumber"),
            *more,
        ))

    @cached_property
    def folders(self) -> DataFrame:
        """Folder tree: distinct proper ancestors of every file, root excluded.

        Map-side partial aggregation removes repeated ancestors before the
        shuffle, so hot top-level folders cost one row per task.
        """
        a = (self.files.select("project_id", F.explode(U.ancestors("path")).alias("path"))
                       .filter(F.col("path") != "/")
                       .distinct())
        return (a.select(
            "project_id",
            folder_id(F.col("project_id"), F.col("path")).alias("data_id"),
            F.lit(K.FOLDER).alias("data_type"),
            "path",
            U.basename("path").alias("name"),
            F.lit(None).cast("bigint").alias("size"),
            F.lit(None).cast("string").alias("etag"),
            F.lit("AVAILABLE").alias("status"),
            F.col("project_id").alias("owning_project_id"),
        ))

    @cached_property
    def inventory(self) -> DataFrame:
        cols = ["project_id", "data_id", "data_type", "path", "name", "size", "etag",
                "status", "owning_project_id"]
        return self.files.select(*cols).unionByName(self.folders.select(*cols))

    # -- external catalog -----------------------------------------------------
    @cached_property
    def external_objects(self) -> DataFrame:
        d = self.raw("documents", ["doc_id", "text", "lang", "source", "n_chars"])
        key = F.concat(F.col("lang"), F.lit("/doc_"), _s("doc_id"), F.lit(".txt"))
        return d.select(
            F.col("doc_id").alias("s3_object_id"),
            F.col("source").alias("bucket"),
            key.alias("key"),
            F.concat(F.lit("s3://"), F.col("source"), F.lit("/"), key).alias("uri"),
            F.col("n_chars").alias("size"),
            F.concat(F.md5("text"), F.when(F.col("n_chars") > 4000, F.lit("-2")).otherwise(F.lit(""))).alias("etag"),
            (F.col("doc_id") % 11 != 0).alias("current_state"),
        )

    @cached_property
    def external_sources(self) -> DataFrame:
        """(request_id, ext_prefix, uri): externalSourceUriList entries; a
        kind-4 request names the document keyed by its customer (customers
        without one have no external source)."""
        d = self.raw("documents", ["doc_id", "lang", "source"])
        r = self.requests.filter(F.col("kind") == 4).select("request_id", "o_custkey")
        j = r.join(d, d.doc_id == F.col("o_custkey"))
        return (j.select(
            "request_id",
            F.lit(0).alias("pos"),
            F.concat(F.lit("s3://"), F.col("source"), F.lit("/")).alias("ext_prefix"),
            F.concat(F.lit("s3://"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/doc_"),
                     _s("doc_id"), F.lit(".txt")).alias("uri"),
        ))

    # -- request sources ------------------------------------------------------
    @cached_property
    def request_sources(self) -> DataFrame:
        r = self.requests
        a = (r.filter(F.col("kind").isin(0, 1, 4))
              .select("request_id", F.lit(0).alias("pos"),
                      U.project_uri(F.col("project_id"), F.col("src_folder")).alias("source_uri")))
        b = (self._files_of(r.filter(F.col("kind").isin(2, 3)).select("request_id"))
              .select("request_id", F.col("l_linenumber").alias("pos"),
                      U.project_uri(F.col("project_id"), F.col("path")).alias("source_uri")))
        c = (self.external_sources.select("request_id", F.lit(1).alias("pos"), F.col("uri").alias("source_uri")))
        return (a.unionByName(b).unionByName(c))

    # -- destination-project inventory ----------------------------------------
    @cached_property
    def destination_inventory(self) -> DataFrame:
        """Files that are at the destination already: named files directly in
        the destination folder, contents of named folders below the folder's
        name."""
        r = self.requests.select("request_id", "kind", "dest_project_id", "dest_path", "src_folder")
        sel = (F.floor(F.col("request_id") / 10) + F.col("l_linenumber")) % 7
        j = self._files_of(r).withColumn("sel", sel).filter(F.col("sel") <= 2)
        return j.select(
            F.col("dest_project_id").alias("project_id"),
            F.concat(F.lit("dst."), _s("request_id"), F.lit("."), _s("l_linenumber")).alias("data_id"),
            F.lit(K.FILE).alias("data_type"),
            F.when(F.col("kind").isin(2, 3), F.concat(F.col("dest_path"), F.col("name"))).otherwise(
                F.concat(F.col("dest_path"), _s("request_id"), F.lit("/"),
                         U.relative_to(F.col("path"), F.col("src_folder")))).alias("path"),
            "name",
            F.when(F.col("sel") == 2, F.col("size") + 1).otherwise(F.col("size")).alias("size"),
            "etag",
            F.when(F.col("sel") == 0, F.lit(K.PARTIAL)).otherwise(F.lit("AVAILABLE")).alias("status"),
            F.col("dest_project_id").alias("owning_project_id"),
        )

    # -- renaming map -----------------------------------------------------------
    @cached_property
    def renaming_map(self) -> DataFrame:
        """Renaming items (FIXTURES.md B ``ren``). Every file of a request's order
        gives an item, in one join: a request of kind 2/3 renames its L1 file
        by URI (1), its L2 file by id (2) and the others by URI or id in turn, a
        request of kind 0/1 renames the files inside its folder by id (L1: 3).
        Items of other lines are numbered from 100."""
        r = self.requests
        nul = F.lit(None).cast("string")
        rid = F.col("request_id")
        kind, ln = F.col("kind"), F.col("l_linenumber")
        base = self._files_of(r.filter(kind.isin(0, 1, 2, 3)).select("request_id", "kind"))
        k23 = kind.isin(2, 3)
        by_uri = k23 & (ln % 2 == 1)
        item = (F.when(k23 & ln.isin(1, 2), ln).when(~k23 & (ln == 1), F.lit(3)).otherwise(ln + 100)).cast("int")
        b123 = base.select(
            rid, item.alias("item"),
            F.when(by_uri, U.project_uri(F.col("project_id"), F.col("path"))).alias("input_uri"),
            F.when(~by_uri, F.col("data_id")).alias("data_id"),
            F.when(item == 3, F.lit("renamed.dat")).otherwise(
                F.concat(F.lit("renamed_L"), _s(ln), F.lit(".dat"))).alias("output_file_name"))
        b4 = self.external_sources.select(rid, F.lit(4).alias("item"), F.col("uri").alias("input_uri"),
                                          nul.alias("data_id"), F.lit("renamed.txt").alias("output_file_name"))
        ck = F.col("o_custkey")

        def one(item, wanted, name, uri=nul, data_id=nul):
            return F.when(wanted, F.struct(F.lit(item).alias("item"), uri.alias("input_uri"),
                                           data_id.alias("data_id"), F.lit(name).alias("output_file_name")))

        def file(line, request=rid):
            return F.concat(F.lit("fil."), _s(request), F.lit(f".{line}"))

        # items that follow from the request alone: one scan for all of them
        own = F.array(
            one(5, ck % 7 == 0, "x.dat", data_id=file(1, rid + 1)),
            one(6, ck % 31 == 0, "y.dat"),
            one(7, ck % 37 == 0, "a//b.dat", data_id=file(1)),
            # both inputs present, one of them invalid
            one(8, ck % 43 == 0, "both_id.dat", F.lit("gs://b/x"), file(3)),
            one(9, ck % 47 == 0, "both_uri.dat", U.project_uri(F.col("project_id"), F.col("src_folder")), F.lit("")),
            # a target that exists, the copied file itself, a file inside a folder
            one(10, k23 & (ck % 3 == 0), "L1.dat", data_id=file(2)),
            one(11, k23 & (ck % 4 == 0), "L3.dat", data_id=file(3)),
            one(12, kind.isin(0, 1) & (ck % 5 == 1), "A", data_id=file(1)))
        rest = (r.select(rid, F.explode(F.filter(own, lambda x: x.isNotNull())).alias("i"))
                 .select("request_id", "i.item", "i.input_uri", "i.data_id", "i.output_file_name"))
        return b123.unionByName(b4).unionByName(rest)

    # -- job states and registry -------------------------------------------------
    @cached_property
    def job_status_events(self) -> DataFrame:
        return job_events_from_events(self.raw("events", ["event_id", "ts", "event_type"]))

    @cached_property
    def job_registry(self) -> DataFrame:
        """(id, id_type, task_token, registered_at)."""
        jb = self.job_status_events
        j = F.col("j")
        reg = (jb.filter((j % 3 != 0) | (j % 9 == 0))
                 .groupBy("job_id", "j").agg(F.min("ts").alias("registered_at"))
                 .select(F.col("job_id").alias("id"),
                         F.when(j % 9 == 0, F.lit("OTHER")).otherwise(F.lit(K.REGISTRY_JOB_ID_TYPE)).alias("id_type"),
                         F.md5("job_id").alias("task_token"), "registered_at"))
        pid = F.concat(F.lit("job-p"), _s(j))
        phantom = (jb.filter(j % 5 == 0).groupBy("j").agg(F.min("ts").alias("registered_at"))
                     .select(pid.alias("id"), F.lit(K.REGISTRY_JOB_ID_TYPE).alias("id_type"),
                             F.md5(pid).alias("task_token"), "registered_at"))
        return reg.unionByName(phantom)

    # -- running requests and storage config ---------------------------------------
    @cached_property
    def executions(self) -> DataFrame:
        r = self.requests
        return r.select(
            F.concat(F.lit("exec-"), _s("request_id")).alias("execution_id"),
            F.when(F.col("request_id") % 20 == 0, F.lit(K.EXECUTION_RUNNING)).otherwise(F.lit("SUCCEEDED")).alias("status"),
            F.to_json(F.struct(F.col("task_token").alias("taskToken"))).alias("input"),
        )

    @cached_property
    def storage_config(self) -> DataFrame:
        r = self.requests
        p = r.select(F.col("project_id")).unionByName(r.select(F.col("dest_project_id").alias("project_id"))).distinct()
        return p.select("project_id", F.concat(F.lit("bkt-"), F.col("project_id")).alias("bucket"),
                        F.lit("byob/").alias("prefix"))
