"""Ordered key/value pairs, as array columns."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_per_key(pairs: Column) -> Column:
    """The last pair of every key, in the order of these pairs.

    One sort by (key, place) brings the pairs of a key together; the last of
    each run stays and is put back in place: n log n for n pairs."""
    placed = F.transform(pairs, lambda e, i: F.struct(e["key"].alias("key"), i.alias("place"), e["value"].alias("value")))
    # one-element arrays bind the sorted pairs to a name, so they are made once
    last = F.transform(F.array(F.array_sort(placed)), lambda a: F.filter(
        a, lambda e, i: F.coalesce(F.get(a, i + 1)["key"] != e["key"], F.lit(True))))[0]
    back = F.array_sort(F.transform(last, lambda e: F.struct(e["place"].alias("place"), e["key"].alias("key"), e["value"].alias("value"))))
    return F.transform(back, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
