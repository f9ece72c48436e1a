"""Column names: quoting, and telling repeated names apart."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

from pyspark.sql import DataFrame


def quoted(name: str) -> str:
    """A name as a back-ticked reference, so dots, spaces and back-ticks are plain characters."""
    return "`" + name.replace("`", "``") + "`"


def unique_names(names: list[str]) -> list[str]:
    """Repeats become `name_k` with the lowest k no other column uses; case matters.

    Names only ever join `used`, so the lowest free suffix of a name never falls and one
    running counter per name is enough.
    """
    used = set(names)
    suffix = defaultdict(lambda: count(1))
    kept: set[str] = set()
    result = []
    for name in names:
        if name not in kept:
            kept.add(name)
            result.append(name)
            continue
        fresh = next(f"{name}_{k}" for k in suffix[name] if f"{name}_{k}" not in used)
        used.add(fresh)
        result.append(fresh)
    return result


def unique_columns(df: DataFrame) -> DataFrame:
    """The same relation with every output name distinct (renamed by position)."""
    names = unique_names(df.columns)
    return df if names == df.columns else df.toDF(*names)
