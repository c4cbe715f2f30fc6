"""Volume bands such as ``50,000+`` or ``1.5B+``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Band suffixes and the form of a band.
SUFFIXES = {"K": 1_000, "M": 1_000_000, "B": 1_000_000_000}
_BAND = r"([\d,.]+)\s*([KMBkmb]?)"


def volume_min(col: Column) -> Column:
    """Lower bound of a volume band as BIGINT; whatever cannot be read is 0.

    A bound beyond BIGINT is also 0 (``try_cast``), so one absurd cell cannot
    fail a job under ANSI mode.
    """
    number = F.replace(F.regexp_extract(col, _BAND, 1), F.lit(","), F.lit("")).try_cast("double")
    suffix = F.upper(F.regexp_extract(col, _BAND, 2))
    sizes = F.create_map(*[F.lit(v) for pair in SUFFIXES.items() for v in pair])
    factor = F.coalesce(F.try_element_at(sizes, suffix), F.lit(1))
    return F.coalesce((number * factor).try_cast("bigint"), F.lit(0).cast("bigint"))
