"""Mergeable centred moments: count, means and sums of centred products.

A part holds, for one group of rows, ``n``, the mean of every column and the
sum of (x - mean x)(y - mean y) of every pair of columns.  Parts of a day merge
into those of a month or year without the rows: with N the count and M the mean
of all of them, the products are the sum of each part's own and of
n (mean x - M x)(mean y - M y).  No raw square is ever summed, so a spread that
is tiny against its mean survives.  Rows in which a column is NULL take no part.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .sequence import null_safe_join


def mean_col(x: str) -> str:
    return f"mean_{x}"


def product_col(x: str, y: str) -> str:
    return f"prod_{x}__{y}"


def co_moments(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One part a group: ``keys``, ``n``, ``mean_x`` and ``prod_x__y`` (x before or
    equal y in ``columns``).  Spark's own averages and covariances are centred and
    combine on the map side, so a hot group is one buffer a task."""
    whole = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).dropna(subset=columns)
    n = F.count(F.lit(1))
    pairs = combinations_with_replacement(columns, 2)
    return whole.groupBy(*keys).agg(
        n.alias("n"), *[F.avg(c).alias(mean_col(c)) for c in columns],
        *[((F.var_pop(x) if x == y else F.covar_pop(x, y)) * n).alias(product_col(x, y)) for x, y in pairs])


def merge_moments(parts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The parts of every group of ``keys`` merged into one.  Means are found
    first and joined back, so no group's parts are gathered."""
    by = keys or ["_one"]
    parts = parts.filter("n > 0").withColumns({} if keys else {"_one": F.lit(0)})
    share = [(F.sum(F.col("n") * F.col(mean_col(c))) / F.sum("n")).alias(f"_all_{c}") for c in columns]
    near = null_safe_join(parts, parts.groupBy(*by).agg(*share), by)

    def off(c: str) -> Column:
        return F.col(mean_col(c)) - F.col(f"_all_{c}")
    return near.groupBy(*by).agg(
        F.sum("n").alias("n"), *[F.first(f"_all_{c}").alias(mean_col(c)) for c in columns],
        *[F.sum(F.col(product_col(x, y)) + F.col("n") * off(x) * off(y)).alias(product_col(x, y))
          for x, y in combinations_with_replacement(columns, 2)]).drop("_one")


def std_of(x: str) -> Column:
    """Sample deviation; NULL below two rows."""
    return F.when(F.col("n") > 1, F.sqrt(F.col(product_col(x, x)) / (F.col("n") - 1)))


def correlation_of(x: str, y: str) -> Column:
    """Pearson r; NULL where a side is constant."""
    size = F.sqrt(F.col(product_col(x, x))) * F.sqrt(F.col(product_col(y, y)))
    return F.try_divide(F.col(product_col(x, y)), F.when(size > 0, size))


def least_squares(part: Row, target: str, features: list[str]) -> tuple[np.ndarray, float]:
    """(intercept and coefficients, R squared) of the target on the features, from
    one part over [*features, target].

    The slopes solve the centred equations, with rank judged on them scaled to
    unit diagonal; the intercept follows from the means.  Where features are
    constant or collinear, the solution of least norm over intercept and
    coefficients is taken, as a solver over all rows would.
    """
    names = [*features, target]
    full = np.array([[part[product_col(*sorted((a, b), key=names.index))] for b in names] for a in names])
    mean = np.array([part[mean_col(c)] for c in names])
    gram, moment, at = full[:-1, :-1], full[:-1, -1], mean[:-1]
    spread = np.diag(gram)
    varies = spread > part["n"] * (1e-13 * np.abs(at)) ** 2
    size = np.sqrt(np.where(varies, spread, 1.0))
    scaled = np.where(np.outer(varies, varies), gram / np.outer(size, size), 0.0)
    values, vectors = np.linalg.eigh(scaled)
    real = values > 1e-10
    used = vectors[:, real]
    slope = (used @ ((used.T @ np.where(varies, moment / size, 0.0)) / values[real])) / size
    intercept = mean[-1] - at @ slope
    if not real.all():  # move within the null space to the least norm
        null, _ = np.linalg.qr(vectors[:, ~real] / size[:, None])
        drift = null.T @ at
        z = np.linalg.solve(np.eye(len(drift)) + np.outer(drift, drift), drift * intercept - null.T @ slope)
        slope = slope + null @ z
        intercept = mean[-1] - at @ slope
    left = full[-1, -1] - 2 * slope @ moment + slope @ gram @ slope
    r2 = 1 - left / full[-1, -1] if full[-1, -1] > 0 else 0.0
    return np.array([intercept, *slope]), float(r2)
