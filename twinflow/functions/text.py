"""Text helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n\f\v"


def strip(text: Column) -> Column:
    """Without white space at either end (``trim`` only knows blanks)."""
    return F.trim(text, F.lit(_BLANKS))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""
