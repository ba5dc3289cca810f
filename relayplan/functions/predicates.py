"""Scalar predicates and classifiers (P-2, P-3, P-4, P-6, P-9, P-10, P-11,
P-13, E-10, E-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.functions.uri import _c, uri_scheme

# multi-part eTag, whole-string match; (?U) gives Python's Unicode \w
STRICT_MULTIPART_RE = r"(?U)\A\w+-\d+\z"

MULTI, SINGLE, UNKNOWN = "MULTI", "SINGLE", "UNKNOWN"


def part_class(etag, mode: str = "strict") -> Column:
    """MULTI / SINGLE / UNKNOWN (null eTag).

    strict: the whole eTag matches ``\\w+-\\d+``; loose: it contains ``-``.
    """
    e = _c(etag)
    if mode == "strict":
        multi = e.rlike(STRICT_MULTIPART_RE)
    elif mode == "loose":
        multi = e.contains("-")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.when(e.isNull(), F.lit(UNKNOWN)).when(multi, F.lit(MULTI)).otherwise(F.lit(SINGLE))


def uri_valid(uri) -> Column:
    """URI pattern with search semantics (the pattern has no right anchor)."""
    return _c(uri).rlike(K.URI_PATTERN)


def scheme_supported(uri) -> Column:
    return uri_scheme(uri).isin(*K.SIZED_SCHEMES)


def one_input(source_uri, data_id) -> Column:
    """Exactly one of the two branches is valid: a source URI of the pattern,
    a data id that is not empty. The other may be present but invalid."""
    s, d = _c(source_uri), _c(data_id)
    uri = F.coalesce(s.rlike(K.URI_PATTERN), F.lit(False))
    ident = F.coalesce(F.length(d) >= 1, F.lit(False))
    return uri != ident


def renaming_item_valid(source_uri, data_id, output_name) -> Column:
    """One valid input and a non-empty output name."""
    o = _c(output_name)
    return one_input(source_uri, data_id) & o.isNotNull() & (F.length(o) >= 1)


def has_rename_input(data_id, input_uri) -> Column:
    return F.coalesce(_c(data_id), _c(input_uri)).isNotNull()


def output_name_valid(name, mode: str = "strict") -> Column:
    """Output file name has no path components.

    strict: non-empty, no ``/``, not ``.`` or ``..``.
    compat: the original test ``str(Path(name)) == name`` — rejects empty
    names, repeated slashes (except exactly two leading ones), a trailing
    slash and ``.`` components, accepts ``a/b.txt`` and ``..``.
    """
    n = _c(name)
    if mode == "strict":
        return n.isNotNull() & (F.length(n) > 0) & ~n.contains("/") & ~n.isin(".", "..")
    if mode == "compat":
        bad = ((F.length(n) == 0)
               | n.rlike(r"[^/]//")
               | n.rlike(r"^///")
               | n.rlike(r"[^/]/\z")
               | (n.rlike(r"(^|/)\.(/|\z)") & (n != F.lit("."))))
        return n.isNotNull() & ~bad
    raise ValueError(f"unknown mode {mode!r}")


def is_partial(status) -> Column:
    return _c(status) == F.lit(K.PARTIAL)


def non_terminal(status) -> Column:
    return _c(status).isin(*K.NON_TERMINAL_STATES)


def summarise_poll(status) -> Column:
    """Polling summary: RUNNING / FAILED / SUCCEEDED (unknown -> SUCCEEDED)."""
    s = _c(status)
    return (F.when(s.isin(*K.NON_TERMINAL_STATES), F.lit("RUNNING"))
             .when(s.isin(*K.POLL_FAILED_STATES), F.lit("FAILED"))
             .otherwise(F.lit("SUCCEEDED")))


def summarise_push(status) -> Column:
    """Notification handling: SUCCESS / NON_TERMINAL / FAILURE (unknown -> FAILURE)."""
    s = _c(status)
    return (F.when(s == F.lit(K.PUSH_SUCCESS_STATE), F.lit("SUCCESS"))
             .when(s.isin(*K.NON_TERMINAL_STATES), F.lit("NON_TERMINAL"))
             .otherwise(F.lit("FAILURE")))


def bool_text(b) -> Column:
    """Lower-case ``true``/``false`` text of a boolean."""
    return F.lower(_c(b).cast("string"))
