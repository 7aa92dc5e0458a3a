"""Text operations of the learning app: a value re-written with its size."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf16_length(s) -> Column:
    """Length in UTF-16 code units (a character outside the BMP counts 2),
    which is what a JVM string reports; Spark's ``length`` counts code points."""
    s = F.col(s) if isinstance(s, str) else s
    return (F.octet_length(F.encode(s, "UTF-16BE")) / 2).cast("int")


def size_content(s) -> Column:
    """``{"size": n, "content": "s"}``, the text passed through as it is
    (no JSON escaping, exactly like the string template it reproduces)."""
    s = F.col(s) if isinstance(s, str) else s
    return F.concat(
        F.lit('{"size": '), utf16_length(s).cast("string"), F.lit(', "content": "'), s, F.lit('"}')
    )
