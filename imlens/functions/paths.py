"""Path, label and URI expressions.

All of them are built-in column expressions, so they stay inside whole-stage codegen and run
next to the scan; no Python worker is involved.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_path(path: ColumnOrName) -> Column:
    """Percent-decode a path once, with the semantics of ``urllib.parse.unquote``.

    ``+`` is kept (``url_decode`` alone would turn it into a space) and a ``%`` that does not
    start a two-digit hex escape is kept literally instead of failing the query.
    """
    p = _c(path)
    protected = F.replace(p, F.lit("+"), F.lit("%2B"))
    protected = F.regexp_replace(protected, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(protected), p)


def label_from_parent(path: ColumnOrName) -> Column:
    """Name of the folder that holds the file: second-to-last ``/`` segment, null when too short."""
    return F.try_element_at(F.split(_c(path), "/"), F.lit(-2))


def label_under(path: ColumnOrName, prefix_regex: str) -> Column:
    """Folder directly under ``prefix_regex`` for a file one level below it; ``''`` otherwise."""
    return F.regexp_extract(_c(path), prefix_regex + r"/([^/]+)/[^/]+$", 1)


def label_from_set(path: ColumnOrName, set_name: str, root: str = "images") -> Column:
    """Label of ``<root>/<set>/<label>/<file>``; ``''`` for any other layout.

    Apply it to the *encoded* path and decode the result afterwards (``decode_path``), so an
    encoded ``/`` inside a folder name cannot shift the segments.
    """
    return label_under(path, re.escape(root) + "/" + re.escape(set_name))


def set_name(path: ColumnOrName, root: str = "images") -> Column:
    """First folder below ``root`` (e.g. ``train`` / ``test``); ``''`` when ``root`` is absent."""
    return F.regexp_extract(_c(path), re.escape(root) + r"/([^/]+)", 1)


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def bucket_and_key(uri: ColumnOrName) -> tuple[Column, Column]:
    """Split ``scheme://bucket/key`` into (bucket, key); ``''`` parts when the form does not match."""
    u = _c(uri)
    bucket = F.regexp_extract(u, _SCHEME + r"([^/]*)", 1)
    key = F.regexp_extract(u, _SCHEME + r"[^/]*/(.*)$", 1)
    return bucket, key
