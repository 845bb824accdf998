"""Flag bits of samples: 0 is good; the cleaning steps add their own bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COSMIC_RAY, GAP = 1, 2


def has_flag(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(F.lit(bit)) != 0


def usable(flags: Column, clean_flags: Column | None = None) -> Column:
    """Good on input and after cleaning."""
    return (flags == 0) if clean_flags is None else (flags == 0) & (F.coalesce(clean_flags, F.lit(0)) == 0)


def is_finite(x: Column) -> Column:
    """A number that is neither null, NaN nor infinite (NaN compares as greater than all)."""
    return F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))
