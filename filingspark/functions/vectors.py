"""Vector arithmetic over ``array<float>`` columns, in double precision."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def constant(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def unit(values: Sequence[float]) -> list[float]:
    norm = math.sqrt(sum(v * v for v in values))
    return [v / norm for v in values]


def _fold(a: Column, b: Column, term) -> Column:
    terms = F.zip_with(a, b, lambda x, y: term(x.cast("double"), y.cast("double")))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _fold(a, b, lambda x, y: x * y)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """NULL for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_fold(a, b, lambda x, y: (x - y) * (x - y)))


def l2_normalise(a: Column) -> Column:
    return F.transform(a, lambda x: F.try_divide(x.cast("double"), norm(a)))


def jaccard(a: Column, b: Column) -> Column:
    """Distance between two sets given as arrays; two empty sets are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(1 - F.size(F.array_intersect(a, b)) / union)


def hamming(a: Column, b: Column) -> Column:
    """Positions at which two bit arrays differ."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x != y).cast("int")), F.lit(0), lambda acc, x: acc + x
    )


def tanimoto(a: Column, b: Column) -> Column:
    """Distance between two bit arrays: 1 - |and| / |or|."""
    both, either = _fold(a, b, lambda x, y: x * y), _fold(a, b, lambda x, y: F.greatest(x, y))
    return F.when(either == 0, 0.0).otherwise(1 - both / either)


def _products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return rows @ queries.T


def _cosines(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1)[:, None] * np.linalg.norm(queries, axis=1)[None, :]
    out = np.full(lengths.shape, np.nan)
    return np.divide(rows @ queries.T, lengths, out=out, where=lengths > 0)


def _distances(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return np.stack([np.linalg.norm(rows - q, axis=1) for q in queries], axis=1)


_DENSE = {"COSINE": _cosines, "IP": _products, "L2": _distances}


def score_all(vector: Column, queries: Sequence[Sequence[float]], metric: str = "COSINE") -> Column:
    """``array<double>`` of one score per query vector; NULL for an undefined score.

    Dense metrics are one matrix product per Arrow batch, which beats folding
    arrays element by element; the set and bit metrics are column expressions.
    """
    if metric not in _DENSE:
        return F.array(*[METRICS[metric][0](vector, constant(q)) for q in queries])
    wanted, measure = np.array(queries, dtype=np.float64), _DENSE[metric]

    @F.pandas_udf("array<double>")
    def score(batch: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
        known = batch[batch.notna()]
        if len(known):
            found = measure(np.array(known.tolist(), dtype=np.float64), wanted)
            rows = [[None if np.isnan(x) else float(x) for x in row] for row in found]
            out.loc[known.index] = pd.Series(rows, index=known.index, dtype=object)
        return out

    return score(vector)


METRICS = {
    "COSINE": (cosine, True),
    "IP": (dot, True),
    "L2": (l2_distance, False),
    "JACCARD": (jaccard, False),
    "HAMMING": (hamming, False),
    "TANIMOTO": (tanimoto, False),
}
