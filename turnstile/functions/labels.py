"""Decoding of codes and names, and labels of ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c: Column | str, mapping: Mapping[str, str], keep_unknown: bool = False) -> Column:
    """Look a value up; an unknown one becomes null, or stays with ``keep_unknown``."""
    c = _col(c)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.element_at(F.create_map(*pairs), c)
    return F.coalesce(found, c) if keep_unknown else found


def first_match(c: Column | str, rules: Mapping[str, str], default: str | None = None) -> Column:
    """CASE over equal values, null (or ``default``) when none is equal."""
    c = _col(c)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, label in rules.items():
        out = out.when(c == value, F.lit(label))
    return out if default is None else out.otherwise(F.lit(default))


def counts_as_ticket(name: Column | str, add_on_token: str) -> Column:
    """1 unless the name contains the (case-sensitive) token; a missing name is 1."""
    return F.when(_col(name).contains(add_on_token), F.lit(0)).otherwise(F.lit(1)).cast("long")


def quantity_if(category: Column | str, wanted: str, qty: Column | str) -> Column:
    return F.when(_col(category) == wanted, _col(qty)).otherwise(F.lit(0))


def rank_label(rank: Column | str, labels: Sequence[str]) -> Column:
    """Sortable label of a rank; past the end of the list, the number itself."""
    rank = _col(rank)
    known = F.array(*[F.lit(x) for x in labels])
    in_list = rank.between(1, len(labels))
    return F.when(in_list, F.element_at(known, F.when(in_list, rank).cast("int"))).otherwise(
        rank.cast("string")
    )
