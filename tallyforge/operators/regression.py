"""Least squares on several targets, with every leave-one-feature-out model, from one pass.

The data are read once for all models: a single aggregate holds the sums of products of intercept,
features and targets per set, and every model is solved from that small table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from tallyforge.functions.vectors import matrix

REPORT = (
    "target string, removed string, intercept double, coefficients map<string, double>, "
    "r2_train double, r2_test double, ratio double, decrease_train double, decrease_test double"
)


def moments(df: DataFrame, columns: Sequence[str], set_column: str) -> DataFrame:
    """``set, pivot, cross``: sums of products of (1, columns...) of train and test, shifted by the columns'
    means so that large means cost no digits.  Rows with a null or NaN in any column are left out.

    A task multiplies its rows as a matrix and passes on one row per set, whatever the number of
    columns; Spark adds those up.
    """
    # One array instead of many columns: planning time does not grow with their number either.
    values = F.array(*[F.col(c).cast("double") for c in columns])
    known = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x))
    everything = df.select(F.col(set_column).cast("string").alias("set"), values.alias("v")).where(known)
    rows = everything.where(F.col("set").isin("train", "test"))
    # The shift may come from all sets, which spares this pass the work of telling them apart.
    means = everything.agg(vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("means")).first()["means"]
    pivot = np.array(means or [0.0] * len(columns))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            codes = coded.indices.to_numpy()
            shifted = matrix(batch.column("v"), len(pivot)) - pivot
            terms = np.column_stack([np.ones(batch.num_rows), shifted])
            for code, name in enumerate(coded.dictionary.to_pylist()):
                own = terms[codes == code]
                sums[name] = sums.get(name, 0.0) + own.T @ own
        names = pa.array(list(sums), pa.string())
        crosses = pa.array([cross.ravel() for cross in sums.values()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([names, crosses], names=["set", "cross"])

    parts = rows.mapInArrow(add_up, "set string, cross array<double>")
    total = vector_to_array(Summarizer.sum(array_to_vector("cross"))).alias("cross")
    return parts.groupBy("set").agg(total).select(
        "set", F.array(*[F.lit(float(p)) for p in pivot]).alias("pivot"), "cross"
    )


def _centred(cross: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and centred sums of products of the (shifted) columns."""
    mean = cross[0, 1:] / cross[0, 0]
    return mean, cross[1:, 1:] - np.outer(mean, mean) * cross[0, 0]


def _solve(train: np.ndarray, use: list[int], target: int) -> tuple[float, np.ndarray]:
    """Intercept and slopes on shifted columns; smallest-norm solution if features depend."""
    mean, spread = _centred(train)
    slopes = np.linalg.lstsq(spread[np.ix_(use, use)], spread[use, target], rcond=None)[0]
    return float(mean[target] - mean[use] @ slopes), slopes


def _r2(cross: np.ndarray, use: list[int], target: int, intercept: float, slopes: np.ndarray) -> float:
    """Coefficient of determination on a set, from its sums; NaN for a constant target."""
    mean, spread = _centred(cross)
    bias = mean[target] - intercept - mean[use] @ slopes
    inner = spread[np.ix_(use, use)]
    left = spread[target, target] - 2 * slopes @ spread[use, target] + slopes @ inner @ slopes
    left += cross[0, 0] * bias * bias
    total = spread[target, target]
    return float(1 - left / total) if total > 0 else float("nan")


def sensitivity(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], set_column: str = "set"
) -> DataFrame:
    """One row per target and model: all features (``removed`` null) and each feature left out.

    Sets are 'train' and 'test'.  ``decrease_*`` is how much the score drops without the feature.
    """
    features, targets = list(features), list(targets)
    sums = moments(df, [*features, *targets], set_column)

    def report(rows: pd.DataFrame) -> pd.DataFrame:
        size = 1 + len(features) + len(targets)
        cross = {r.set: np.array(r.cross).reshape(size, size) for r in rows.itertuples()}
        if not {"train", "test"} <= set(cross):
            raise ValueError("both a train and a test set are needed")
        pivot = np.array(rows["pivot"].iloc[0])
        out = []
        for t, target in enumerate(targets):
            column = len(features) + t
            full = None
            for removed in [None, *range(len(features))]:
                use = [i for i in range(len(features)) if i != removed]
                a, b = _solve(cross["train"], use, column)
                train = _r2(cross["train"], use, column, a, b)
                test = _r2(cross["test"], use, column, a, b)
                full = full or (train, test)
                out.append(
                    {
                        "target": target,
                        "removed": None if removed is None else features[removed],
                        "intercept": a + pivot[column] - float(pivot[use] @ b),
                        "coefficients": {features[i]: float(x) for i, x in zip(use, b)},
                        "r2_train": train,
                        "r2_test": test,
                        "ratio": test / train if train else float("nan"),
                        "decrease_train": full[0] - train,
                        "decrease_test": full[1] - test,
                    }
                )
        return pd.DataFrame(out)

    return sums.groupBy().applyInPandas(report, REPORT)


def coefficients(report: DataFrame) -> DataFrame:
    """``target, feature, coefficient`` of the full models."""
    full = report.where(F.col("removed").isNull())
    return full.select("target", F.explode("coefficients").alias("feature", "coefficient"))


def fit(df: DataFrame, features: Sequence[str], target: str) -> LinearRegressionModel:
    """A single model by Spark ML, for prediction over tables with :func:`predict`."""
    rows = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    learner = LinearRegression(labelCol=target, solver="normal", regParam=0.0, standardization=False)
    return learner.fit(rows)


def predict(model: LinearRegressionModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    rows = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return model.transform(rows).drop("features")
