"""Time parts of a request."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinflow.schemas import MAX_MILLIS, MIN_MILLIS, TIME_UNITS


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970, rounded down."""
    return F.unix_millis(ts.cast("timestamp"))


def in_calendar(millis: Column) -> Column:
    return F.coalesce(millis.between(MIN_MILLIS, MAX_MILLIS), F.lit(False))


def ordered(tstart: Column, tend: Column) -> Column:
    return F.coalesce(tstart <= tend, F.lit(False))


def known_unit(tunit: Column) -> Column:
    return F.coalesce(F.lower(tunit).isin(*TIME_UNITS), F.lit(False))
