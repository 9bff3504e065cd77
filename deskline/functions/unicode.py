"""Two steps with no built-in Spark function, as Arrow UDFs.

Each UDF sees null for every text it would leave unchanged, so only the texts
that need it are worked on in Python. The functions are nested so that they are
shipped by value: executors need pyarrow but not this package.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from deskline.functions import patterns as p
from deskline.functions.text import is_ascii


def _unescape_udf():
    def unescape(texts: pa.Array) -> pa.Array:
        import html

        import pyarrow

        return pyarrow.array(
            [None if t is None else html.unescape(t) for t in texts.to_pylist()], pyarrow.string()
        )

    return F.arrow_udf(unescape, "string")


def _nfc_udf():
    def nfc(texts: pa.Array) -> pa.Array:
        import unicodedata

        import pyarrow

        return pyarrow.array(
            [None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()],
            pyarrow.string(),
        )

    return F.arrow_udf(nfc, "string")


def unescape_html(text: Column) -> Column:
    """Decode HTML5 character references. ``text`` should be a plain column: it is
    named more than once."""
    return F.coalesce(_unescape_udf()(F.when(F.contains(text, F.lit("&")), text)), text)


def to_nfc(text: Column) -> Column:
    """Unicode normalization form C. ``text`` should be a plain column: it is named
    more than once."""
    return F.coalesce(_nfc_udf()(F.when(~is_ascii(text) & text.rlike(p.MAYBE_NOT_NFC), text)), text)
