"""Dense vectors held as ``array<double>`` and their flat form with one column per entry."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["as_vector", "as_array", "zeros", "dense_from_entries", "flatten_arrays", "gather_arrays"]


def as_vector(array: Column) -> Column:
    return array_to_vector(array.cast("array<double>"))


def as_array(vector: Column) -> Column:
    return vector_to_array(vector)


def zeros(size: int) -> Column:
    return F.array_repeat(F.lit(0.0), size)


def dense_from_entries(entries: Column, size: int) -> Column:
    """Dense array from ``array<struct<idx:int, w:double>>``, entries in any order."""
    ordered = F.array_sort(entries)
    # Pair every entry with the one before it and fill the gap in between with zeros: linear
    # in the size of the result.
    before = F.concat(F.array(F.lit(-1)), F.transform(ordered, lambda e: e["idx"]))
    before = F.slice(before, 1, F.size(ordered))
    pieces = F.zip_with(
        before,
        ordered,
        lambda b, e: F.concat(F.array_repeat(F.lit(0.0), e["idx"] - b - 1), F.array(e["w"])),
    )
    head = F.flatten(pieces)
    return F.concat(head, F.array_repeat(F.lit(0.0), F.lit(size) - F.size(head)))


def flatten_arrays(df: DataFrame, sizes: dict[str, int], names: dict[str, str] | None = None) -> DataFrame:
    """Spread each array column of ``sizes`` over ``<name>_0 .. <name>_<size-1>``."""
    names = names or {}
    out: list[Column] = []
    for column in df.columns:
        if column in sizes:
            stem = names.get(column, column)
            out += [F.col(column)[i].alias(f"{stem}_{i}") for i in range(sizes[column])]
        else:
            out.append(F.col(column))
    return df.select(*out)


def gather_arrays(df: DataFrame, stems: dict[str, str]) -> DataFrame:
    """Inverse of :func:`flatten_arrays`: ``stems`` maps a column stem to an element type."""
    numbered: dict[str, list[tuple[int, str]]] = {}
    plain = []
    for column in df.columns:
        stem, _, number = column.rpartition("_")
        if stem in stems and number.isdigit():
            numbered.setdefault(stem, []).append((int(number), column))
        else:
            plain.append(F.col(column))
    arrays = [
        F.array(*[F.coalesce(F.col(c).cast(stems[stem]), F.lit(0).cast(stems[stem])) for _, c in sorted(found)]).alias(stem)
        for stem, found in numbered.items()
    ]
    return df.select(*plain, *arrays)
