"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands in for NULL and what joins the parts of a key.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: str | Column) -> Column:
    """MD5 over the text of the columns; NULL and '' give different keys."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    text = [F.coalesce(p.cast("string"), F.lit(NULL_MARKER)) for p in parts]
    return F.md5(F.concat_ws(SEPARATOR, *text))
