"""Scalar functions by name for SQL. What Spark expressions cannot say is registered; the rest are expressions already."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.repetition import collapse_repetition
from sparkloom.functions.tables import html_to_matrix, matrix_to_html
from sparkloom.ship import ship

#: Name, function of one text.
SCALARS = {
    "collapse_repetition": collapse_repetition,
    "collapse_repetition_observed": lambda t: collapse_repetition(t, observed=True),
    "table_matrix_to_html": matrix_to_html,
    "table_html_to_matrix": html_to_matrix,
}


def _vectorised(function):
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda t: None if t is None else function(t))

    return run


def register(spark: SparkSession) -> list[str]:
    """Registers all scalars in a session and returns their names."""
    ship(spark)
    for name, function in SCALARS.items():
        spark.udf.register(name, _vectorised(function))
    return sorted(SCALARS)
