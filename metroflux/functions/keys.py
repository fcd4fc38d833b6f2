"""Surrogate keys with a portable text form.

The key hashes a canonical text of each part, so any engine that renders the
same text produces the same key: integers as digits, doubles as whole part and
fraction (`exact_text`: no digit is cut), decimals as they print, timestamps as 'yyyy-MM-dd HH:mm:ss.SSSSSS', NULL as a
sentinel, parts joined by a separator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroflux.functions.numeric import exact_text
from metroflux.schemas import KEY_NULL, KEY_SEPARATOR


def key_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        txt = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        txt = exact_text(c)
    elif isinstance(dtype, T.DateType):
        txt = F.date_format(c, "yyyy-MM-dd")
    else:
        txt = c.cast("string")
    return F.coalesce(txt, F.lit(KEY_NULL))


def surrogate_key(df, cols: list[str]) -> Column:
    """md5 of the canonical text of `cols` of `df`."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [key_text(F.col(c), types[c]) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
