"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def site_id(site: Column) -> Column:
    """``"12.0"`` and ``"12"`` name the same site; a fraction is cut off as the
    original rules do, and anything but a plain number stays as it is."""
    whole = F.regexp_extract(site, r"^\s*([+-]?\d+)(\.\d*)?\s*$", 1).try_cast("decimal(38,0)")
    return F.coalesce(whole.cast("string"), site)
