"""URI and path column functions (E-1 .. E-9, E-14, E-15).

All are native column expressions (regexp, string, higher-order array
functions), so they stay inside whole-stage codegen. ``parse_url`` is not
used: it returns NULL hosts for names with ``_`` and fails on spaces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relayplan.constants import PROJECT_SCHEME

# Regexes, written once so Spark code and SQL oracles use the same text.
SCHEME_RE = r"^([^:/?#]+)://"
NETLOC_RE = r"^[^:/?#]+://([^/]*)"
PATH_RE = r"^[^:/?#]+://[^/]*(/.*)?\z"
# tried at the start of a component only
PARENT_RE = r"(?<![^/])[^/]+/?\z"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def uri_scheme(uri) -> Column:
    return F.regexp_extract(_c(uri), SCHEME_RE, 1)


def uri_netloc(uri) -> Column:
    return F.regexp_extract(_c(uri), NETLOC_RE, 1)


def uri_path(uri, compat: bool = False) -> Column:
    """Path part. ``compat`` cuts ``?query`` and ``#fragment`` like urlparse."""
    p = F.regexp_extract(_c(uri), PATH_RE, 1)
    if compat:
        p = F.regexp_extract(p, r"^([^?#]*)", 1)
    return p


def uri_parts(uri) -> dict[str, Column]:
    return {"scheme": uri_scheme(uri), "netloc": uri_netloc(uri), "path": uri_path(uri)}


def uri_build(scheme, netloc, path) -> Column:
    return F.concat(_c(scheme), F.lit("://"), _c(netloc), _c(path))


def basename(path) -> Column:
    """Last component, ignoring trailing ``/``. Apply to a path, not a URI."""
    return F.substring_index(F.rtrim(_c(path), F.lit("/")), "/", -1)


def parent(path) -> Column:
    """Parent folder, keeping the trailing ``/``: ``/a/b/c`` -> ``/a/b/``."""
    return F.regexp_replace(_c(path), PARENT_RE, "")


def normalise_path(path) -> Column:
    """Collapse ``//`` and ``/./`` like a path join would."""
    p = F.regexp_replace(_c(path), r"/(\./)+", "/")
    return F.regexp_replace(p, "//+", "/")


def path_join(a, b) -> Column:
    return normalise_path(F.concat(_c(a), F.lit("/"), _c(b)))


def as_folder(path) -> Column:
    """Make sure a folder path ends in exactly one ``/``."""
    return F.concat(F.rtrim(_c(path), F.lit("/")), F.lit("/"))


def path_contains(folder, path) -> Column:
    return _c(path).startswith(as_folder(folder))


def relative_to(path, folder) -> Column:
    """Path below ``folder``; only meaningful where ``path_contains`` holds."""
    start = F.length(as_folder(folder)) + 1
    return _c(path).substr(start, F.length(_c(path)) - start + 1)


def strip_leading_slash(path) -> Column:
    return F.regexp_replace(_c(path), "^/+", "")


def project_uri(project_id, path) -> Column:
    return F.concat(F.lit(PROJECT_SCHEME + "://"), _c(project_id), _c(path))


def s3_uri(bucket, prefix, path) -> Column:
    return F.concat(F.lit("s3://"), _c(bucket), F.lit("/"), _c(prefix), strip_leading_slash(path))


def slashes(path) -> Column:
    """How many ``/`` a path holds; the ``i``-th of ``ancestors`` holds ``i``."""
    return F.length(_c(path)) - F.length(F.replace(_c(path), F.lit("/")))


def ancestors(path, levels=None) -> Column:
    """Proper ancestor folders of a path, each ending in ``/``.

    ``/a/b/c.txt`` and ``/a/b/c/`` both give ``[/, /a/, /a/b/]``. Used to turn
    prefix containment into an equi-join key. ``levels`` (an array column)
    keeps the ancestors with so many ``/``.
    """
    p = F.rtrim(_c(path), F.lit("/"))
    n = slashes(p)
    anc = lambda wanted: F.transform(
        wanted, lambda i: F.concat(F.call_function("substring_index", p, F.lit("/"), i), F.lit("/")))
    if levels is None:
        wanted = F.sequence(F.lit(1), n)
    else:
        wanted = F.filter(_c(levels), lambda i: (i >= 1) & (i <= n))
    return F.when(n >= 1, anc(wanted)).otherwise(F.array().cast("array<string>"))


def spread_null(key, *others) -> Column:
    """A join key whose nulls become different values that no key equals, so
    that they are spread over the partitions of an outer join, not gathered
    in one."""
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*[_c(o) for o in others]).cast("string"))
    return F.coalesce(_c(key), salt)
