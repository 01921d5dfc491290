"""Location lookups (J1) over a locations table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def find_locations(locs: DataFrame, name: str | None = None, kind: str | None = None,
                   code: int | None = None) -> DataFrame:
    """Locations whose name contains ``name`` (case-insensitive).

    ``city`` matches only the part before the first comma of City rows;
    ``state`` and ``country`` match rows of that type; ``code`` looks a
    location up by its code instead.
    """
    if code is not None:
        return locs.where(F.col("location_code") == code)
    q = F.lit((name or "").lower())
    full = F.lower(F.col("location_name"))
    if kind is None:
        return locs.where(full.contains(q))
    kind_l = kind.lower()
    typ = F.lower(F.col("location_type"))
    if kind_l == "city":
        head = F.lower(F.split_part(F.col("location_name"), F.lit(","), F.lit(1)))
        return locs.where((typ == "city") & head.contains(q))
    return locs.where((typ == kind_l) & full.contains(q))
