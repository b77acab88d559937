"""ISO-like time strings as timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)? ?(Z|z|[+-]\d{2}:?\d{2})?$"
_ZONED = r"(Z|z|[+-]\d{2}:?\d{2})$"


def instant(text: Column, zone: str = "+08:00") -> Column:
    """The instant a string names; one without a zone is in ``zone``. Anything that is no such time gives null."""
    t = F.trim(text)
    dated = F.when(F.length(t) == 10, F.concat(t, F.lit(" 00:00:00"))).otherwise(t)
    full = F.when((F.length(t) > 10) & t.rlike(_ZONED), dated).otherwise(F.concat(dated, F.lit(zone)))
    return F.when(t.rlike(_SHAPE), full.try_cast("timestamp"))


def month_of(at: Column, zone: str = "+08:00") -> Column:
    """``yyyy-MM`` of an instant on the clocks of ``zone``, whatever the session's zone; null gives null."""
    local = F.convert_timezone(F.current_timezone(), F.lit(zone), at.cast("timestamp_ntz"))
    return F.date_format(local, "yyyy-MM")
