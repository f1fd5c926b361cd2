"""Identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def alert_id(prefix: str, *parts: Column | str) -> Column:
    """``<prefix>-<part>-<part>...``; NULL parts are skipped (``concat_ws``)."""
    return F.concat_ws("-", F.lit(prefix), *[F.col(p) if isinstance(p, str) else p for p in parts])


def id_number(ident: Column | str, prefix: str = "WL") -> Column:
    """Numeric part of an id such as ``WL000017`` (17); NULL when unreadable
    or when the id does not carry ``prefix``."""
    col = F.col(ident) if isinstance(ident, str) else ident
    digits = F.substr(col, F.lit(len(prefix) + 1))      # to the end of the text
    return F.when(col.startswith(prefix), digits.try_cast("bigint"))
