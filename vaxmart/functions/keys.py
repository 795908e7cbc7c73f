"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: str | Column, separator: str = "") -> Column:
    """MD5 (lower-case hex) of the text of ``cols``, nulls read as ``''``.

    With the default empty separator the key matches the warehouse model
    exactly, including its collisions (``'8' + '51'`` == ``'85' + '1'``);
    pass a separator for collision-free keys in new models.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    text = parts[0] if len(parts) == 1 else (F.concat_ws(separator, *parts) if separator else F.concat(*parts))
    return F.md5(text)
