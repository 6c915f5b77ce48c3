"""The few text steps that have no Spark built-in, as Arrow UDFs.

Callers send only the rows that need them (see ``text.py``); all other rows
arrive as NULL and cost nothing on the Python side.
"""

from __future__ import annotations

import html
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDED = T.StructType(
    [T.StructField("match", T.StringType()), T.StructField("leet", T.StringType())]
)


def _each(values: pa.Array, fn) -> pa.Array:
    return pa.array(
        [None if v is None else fn(v) for v in values.to_pylist()], type=pa.string()
    )


@F.arrow_udf(T.StringType())
def unescape_html(values: pa.Array) -> pa.Array:
    return _each(values, html.unescape)


@F.arrow_udf(T.ArrayType(T.StringType()))
def unescape_html_array(values: pa.Array) -> pa.Array:
    rows = [
        None if row is None else [None if v is None else html.unescape(v) for v in row]
        for row in values.to_pylist()
    ]
    return pa.array(rows, type=pa.list_(pa.string()))


@F.arrow_udf(FOLDED)
def fold_unicode(values: pa.Array) -> pa.Array:
    """NFKC, then casefold (``match``) or lower case (``leet``)."""
    wide = _each(values, lambda v: unicodedata.normalize("NFKC", v))
    return pa.StructArray.from_arrays(
        [_each(wide, str.casefold), _each(wide, str.lower)], names=["match", "leet"]
    )
