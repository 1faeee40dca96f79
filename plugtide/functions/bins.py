"""Left-closed bins as a CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def left_closed(value: Column, bins: list[tuple[float, str]], upper: float | None = None) -> Column:
    """Label of the bin holding `value`; NULL below the first bound and from `upper` on."""
    case = F.when(value < F.lit(float(bins[0][0])), F.lit(None).cast("string"))
    if upper is not None:
        case = case.when(value >= F.lit(upper), F.lit(None).cast("string"))
    for bound, label in reversed(bins):
        case = case.when(value >= F.lit(float(bound)), F.lit(label))
    return case
