"""Totals written as labelled grouping sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_totals(
    df: DataFrame,
    period: Sequence[str],
    dims: Sequence[str],
    sums: Mapping[str, str],
    total: str,
    levels: Mapping[tuple[str, ...], str] | None = None,
    level_name: str = "aggregation_level",
) -> DataFrame:
    """Sums for every subset of ``dims`` within a period; a summed-up dim reads ``total``.

    ``sums`` names the output sum of each input column.  The details are summed
    first: that is where the rows shrink, and only the short result is then
    multiplied by the grouping sets.  ``grouping()`` tells a total from a
    detail whose value is null.  ``levels`` labels each set by the dims it keeps.
    """
    detail = df.groupBy(*period, *dims).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    kept = [s for k in range(len(dims), -1, -1) for s in combinations(dims, k)]
    sets = [[*period, *s] for s in kept]
    cubed = detail.groupingSets(sets, *period, *dims).agg(
        *[F.sum(n).alias(n) for n in sums], *[F.grouping(d).alias(f"__all_{d}") for d in dims]
    )
    out = [F.col(c) for c in period]
    out += [F.when(F.col(f"__all_{d}") == 1, F.lit(total)).otherwise(F.col(d)).alias(d) for d in dims]
    out += [F.col(n) for n in sums]
    if levels:
        label = F.lit(None).cast("string")
        for keeps, text in levels.items():
            here = F.lit(True)
            for d in dims:
                here = here & (F.col(f"__all_{d}") == (0 if d in keeps else 1))
            label = F.when(here, F.lit(text)).otherwise(label)
        out.append(label.alias(level_name))
    return cubed.select(*out)
