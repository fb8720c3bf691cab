"""Date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accepted text formats, tried in this order
DATE_FORMATS = ("M/d/yyyy", "yyyy-M-d", "d/M/yyyy")


def parse_date(c: Column | str) -> Column:
    """First format that fits, else null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_date(c, f) for f in DATE_FORMATS])


def parse_filing_date(c: Column | str) -> Column:
    """Filing dates are only ever read in the month-first format; other text is null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(c, DATE_FORMATS[0])


def quarter_label(c: Column | str) -> Column:
    """``2023-Q4``."""
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def quarter_id(c: Column | str) -> Column:
    """``20234``."""
    return (F.year(c) * 10 + F.quarter(c)).cast("long")
