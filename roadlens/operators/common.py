"""Small shared helpers for operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadlens.functions.text import is_empty


def legal_cars(flow: DataFrame) -> DataFrame:
    """Drop passes without a plate (null or blank); they would form one huge group."""
    return flow.filter(~is_empty(F.trim(F.col("car"))))
