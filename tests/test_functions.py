"""Scalar functions on the hand-written edge rows (FIXTURES.md D)."""

from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from relayplan.functions import predicates as P
from relayplan.functions import uri as U


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_part_class_strict_and_loose(spark):
    rows = ["abc-12", "abc-12x", "a-b-3", "abc", "é-3", "abc-12\n", None]
    df = one_col(spark, rows, "etag").select(
        "etag", P.part_class("etag", "strict").alias("s"), P.part_class("etag", "loose").alias("l"))
    got = {r.etag: (r.s, r.l) for r in df.collect()}
    assert got["abc-12"] == ("MULTI", "MULTI")
    assert got["abc-12x"] == ("SINGLE", "MULTI")       # strict and loose disagree
    assert got["a-b-3"] == ("SINGLE", "MULTI")
    assert got["abc"] == ("SINGLE", "SINGLE")
    assert got["é-3"] == ("MULTI", "MULTI")            # \w is Unicode, like Python
    assert got["abc-12\n"] == ("SINGLE", "MULTI")      # \z: no match before a final newline
    assert got[None] == ("UNKNOWN", "UNKNOWN")


def test_uri_split(spark):
    rows = ["icav2://prj_1/a/b.txt", "s3://bucket.with.dots/k", "s3://b/a#b?c", "icav2://p/a b.txt",
            "icav2:///x", "gs://b/k", "s3://b"]
    p = U.uri_path("v")
    df = one_col(spark, rows).select("v", U.uri_scheme("v").alias("s"), U.uri_netloc("v").alias("n"),
                                     p.alias("p"), U.basename(p).alias("b"), U.parent(p).alias("par"),
                                     U.uri_path("v", compat=True).alias("pc"))
    got = {r.v: (r.s, r.n, r.p, r.b, r.par, r.pc) for r in df.collect()}
    assert got["icav2://prj_1/a/b.txt"] == ("icav2", "prj_1", "/a/b.txt", "b.txt", "/a/", "/a/b.txt")
    assert got["s3://bucket.with.dots/k"][:3] == ("s3", "bucket.with.dots", "/k")
    assert got["s3://b/a#b?c"][2] == "/a#b?c"           # key kept whole
    assert got["s3://b/a#b?c"][5] == "/a"               # compat cuts like urlparse
    assert got["icav2://p/a b.txt"][2:4] == ("/a b.txt", "a b.txt")
    assert got["icav2:///x"][1:3] == ("", "/x")
    assert got["gs://b/k"][0] == "gs"
    assert got["s3://b"][1:4] == ("b", "", "")         # no path, no name


def test_uri_pattern(spark):
    df = one_col(spark, ["icav2://p/f.txt", "s3://my.bucket/k", "s3://b/k", "gs://b/k"]).select(
        "v", P.uri_valid("v").alias("ok"))
    got = {r.v: r.ok for r in df.collect()}
    assert got == {"icav2://p/f.txt": True, "s3://my.bucket/k": False, "s3://b/k": True, "gs://b/k": False}


NAMES = ["a.txt", "a/b.txt", "..", ".", "a//b", "a/", "./a", "", "//a", "///a", "a/./b", "a/.", "/", "//",
         "x/..", "a b", "/a"]


def test_output_name_compat_matches_pathlib(spark):
    df = one_col(spark, NAMES).select("v", P.output_name_valid("v", "compat").alias("c"),
                                      P.output_name_valid("v", "strict").alias("s"))
    got = {r.v: (r.c, r.s) for r in df.collect()}
    for n in NAMES:
        assert got[n][0] == (str(PurePosixPath(n)) == n), n
    assert got["a.txt"] == (True, True)
    assert got["a/b.txt"] == (True, False)
    assert got[".."] == (True, False)
    assert got["a//b"] == (False, False)


def test_null_safe_size_compare(spark):
    from relayplan.operators.verify import _compare
    df = spark.createDataFrame([(None, None), (None, 1), (2, 2), (2, 3)], "e long, a long")
    r = df.select(_compare(F.col("e"), F.col("a"), F.lit(True), True).alias("ns"),
                  _compare(F.col("e"), F.col("a"), F.lit(True), False).alias("strict")).collect()
    assert [x.ns for x in r] == ["OK", "MISMATCH", "OK", "MISMATCH"]
    assert [x.strict for x in r] == ["MISMATCH", "MISMATCH", "OK", "MISMATCH"]


def test_status_mappings_unknown_state(spark):
    df = one_col(spark, ["ABORTED", "RUNNING", "STOPPED", "SUCCEEDED"], "s").select(
        "s", P.summarise_poll("s").alias("poll"), P.summarise_push("s").alias("push"))
    got = {r.s: (r.poll, r.push) for r in df.collect()}
    assert got["ABORTED"] == ("SUCCEEDED", "FAILURE")     # the two mappings disagree
    assert got["RUNNING"] == ("RUNNING", "NON_TERMINAL")
    assert got["STOPPED"] == ("FAILED", "FAILURE")
    assert got["SUCCEEDED"] == ("SUCCEEDED", "SUCCESS")


def test_renaming_item_one_of(spark):
    df = spark.createDataFrame([("icav2://p/a", None, "x"), (None, "fil.1", "x"), ("icav2://p/a", "fil.1", "x"),
                                (None, None, "x"), ("s3://my.b/k", None, "x"), (None, "fil.1", ""),
                                ("gs://b/x", "fil.1", "x"), ("icav2://p/a", "", "x"), ("gs://b/x", "", "x")],
                               "u string, d string, o string")
    r = df.select(P.renaming_item_valid("u", "d", "o").alias("v"), P.has_rename_input("d", "u").alias("h")).collect()
    assert [x.v for x in r] == [True, True, False, False, False, False, True, True, False]
    assert [x.h for x in r] == [True, True, True, False, True, True, True, True, True]


@pytest.mark.parametrize("path,expected", [
    ("/a/b/c.txt", ["/", "/a/", "/a/b/"]),
    ("/a/b/c/", ["/", "/a/", "/a/b/"]),
    ("/x", ["/"]),
    ("/", []),
])
def test_ancestors(spark, path, expected):
    r = one_col(spark, [path]).select(U.ancestors("v").alias("a")).collect()[0].a
    assert r == expected


def test_path_helpers(spark):
    df = spark.createDataFrame([("/copies/1", "L1.dat", "/runs/1/A/L1.dat", "/runs/1/")], "a string, b string, p string, f string")
    r = df.select(U.path_join("a", "b").alias("j"), U.as_folder("a").alias("af"),
                  U.path_contains("f", "p").alias("c"), U.relative_to("p", "f").alias("rel"),
                  U.strip_leading_slash("p").alias("k"), U.project_uri(F.lit("prj"), F.col("p")).alias("u"),
                  U.s3_uri(F.lit("bkt"), F.lit("byob/"), F.col("p")).alias("s3")).collect()[0]
    assert r.j == "/copies/1/L1.dat" and r.af == "/copies/1/" and r.c is True
    assert r.rel == "A/L1.dat" and r.k == "runs/1/A/L1.dat"
    assert r.u == "icav2://prj/runs/1/A/L1.dat" and r.s3 == "s3://bkt/byob/runs/1/A/L1.dat"


def test_uri_split_agrees_with_urlparse(spark, sf_small):
    """scheme, netloc and the compat path equal Python's urlparse (the
    original's parser) on the edge rows and every page URL."""
    from urllib.parse import urlparse
    edge = ["icav2://prj_1/a/b.txt", "s3://bucket.with.dots/k", "s3://b/a#b?c", "icav2://p/a b.txt",
            "icav2:///x", "gs://b/k", "s3://b"]
    pages = [r.url for r in spark.read.parquet(f"{sf_small}/pages.parquet").select("url").collect()]
    df = one_col(spark, edge + pages).select("v", U.uri_scheme("v").alias("s"), U.uri_netloc("v").alias("n"),
                                             U.uri_path("v", compat=True).alias("p"))
    for r in df.collect():
        u = urlparse(r.v)
        assert (r.s, r.n, r.p) == (u.scheme, u.netloc, u.path), r.v


def test_part_class_and_basename_agree_with_python(spark, sf_small):
    """strict part class = re.fullmatch(r"\\w+-\\d+", etag); basename =
    PurePosixPath(path).name, on the fixture inventory and edge rows."""
    import re

    from relayplan.sources.tables import Tables
    inv = Tables(spark, sf_small).inventory.filter("data_type = 'FILE'").select(
        "etag", "path", P.part_class("etag", "strict").alias("c"), U.basename("path").alias("b"))
    edge = one_col(spark, ["abc-12", "abc-12x", "a-b-3", "é-3", "x_y-7", "-3", "a-"], "etag").select(
        "etag", F.lit("/a/b/").alias("path"), P.part_class("etag", "strict").alias("c"), U.basename(F.lit("/a/b/")).alias("b"))
    rx = re.compile(r"\w+-\d+")
    for r in inv.unionByName(edge).collect():
        want = "UNKNOWN" if r.etag is None else ("MULTI" if rx.fullmatch(r.etag) else "SINGLE")
        assert r.c == want, r.etag
        assert r.b == PurePosixPath(r.path).name, r.path


def test_path_join_agrees_with_pathlib(spark):
    pairs = [(a, b) for a in ["/copies/10", "/copies/10/", "/a//b", "/a/./b", "/"]
             for b in ["x", "y/z", "./w", "n.dat"]]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", U.path_join("a", "b").alias("j"))
    for r in df.collect():
        assert r.j == str(PurePosixPath(r.a) / r.b), (r.a, r.b)


def test_pair_destination_compat_quirks(spark):
    from relayplan.operators.verify import pair_destination
    df = spark.createDataFrame([("icav2://p/d", "icav2://p/src/f.txt"), ("icav2://p/d/", "s3://b/a#b?c")],
                               "d string, s string")
    r = df.select(pair_destination(F.col("d"), F.col("s")).alias("norm"),
                  pair_destination(F.col("d"), F.col("s"), compat=True).alias("compat")).collect()
    assert (r[0].norm, r[0].compat) == ("icav2://p/d/f.txt", "icav2://p/df.txt")     # Q10
    assert (r[1].norm, r[1].compat) == ("icav2://p/d/a#b?c", "icav2://p/d/a")        # Q19


def test_path_functions_agree_with_their_definitions(spark):
    """Base name, parent, folder form and normal form equal the plain patterns."""
    paths = ["", "/", "//", "a", "a/", "/a", "/a/", "/a//", "/a/b", "/a//b", "/a/./b", "/a/././b//", "./a", "/./", "/.//b",
             "/a/b/c.txt", "a//b//", "/\n/b", "/x\n", None]
    df = spark.createDataFrame([(p,) for p in paths], "v string")
    got = df.select("v", U.basename("v").alias("b"), F.regexp_extract("v", r"([^/]+)/*\z", 1).alias("b0"),
                    U.parent("v").alias("p"), F.regexp_replace("v", r"[^/]+/?\z", "").alias("p0"),
                    U.as_folder("v").alias("f"), F.regexp_replace(F.concat("v", F.lit("/")), r"/+\z", "/").alias("f0"),
                    U.normalise_path("v").alias("n"),
                    F.regexp_replace(F.regexp_replace("v", r"/(\./)+", "/"), "/+", "/").alias("n0")).collect()
    for r in got:
        assert (r.b, r.p, r.f, r.n) == (r.b0, r.p0, r.f0, r.n0), r.v
