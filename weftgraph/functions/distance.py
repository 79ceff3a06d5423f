"""Vector distances: names, and the column form for one pair per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of each metric.
METRICS = {
    "cosine": "cosine",
    "angular": "cosine",
    "l2": "l2",
    "euclidean": "l2",
    "dot": "dot",
    "dot_product": "dot",
    "ip": "dot",
    "inner_product": "dot",
    "l1": "l1",
    "manhattan": "l1",
}


def check_metric(metric: str) -> str:
    """The canonical metric name; an unknown one is an error."""
    name = METRICS.get(str(metric).lower())
    if name is None:
        raise ValueError(f"unknown metric {metric!r}; expected one of {sorted(METRICS)}")
    return name


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def inner_product(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def distance(a: Column | str, b: Column | str, metric: str = "cosine") -> Column:
    """Distance of two array columns, smaller is closer; NULL where cosine has no meaning."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    name = check_metric(metric)
    if name == "dot":
        return -inner_product(a, b)
    if name == "cosine":
        return 1 - F.try_divide(inner_product(a, b), norm(a) * norm(b))
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    if name == "l2":
        return F.sqrt(_total(F.transform(gaps, lambda x: x * x)))
    return _total(F.transform(gaps, F.abs))
