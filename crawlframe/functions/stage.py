"""Evaluate an expression once per row.

Catalyst substitutes aliases into the filters and projections above them, so a costly expression that
is used ten times would be planned and run ten times. A one-element generator keeps its result as a
plain attribute; it runs inside whole-stage codegen and moves no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlframe.functions.urls import url_parts, url_pieces


def compute_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add or replace a column whose expression is evaluated exactly once per row."""
    keep = [c for c in df.columns if c != name]
    return df.select(*keep, F.explode(F.array(expr)).alias(name))


def with_parts(df: DataFrame, url: str = "url", name: str = "_p") -> DataFrame:
    """Add the parts of a URL column as a struct."""
    cut = compute_once(df, "_pieces", url_pieces(F.col(url)))
    return compute_once(cut, name, url_parts(F.col(url), F.col("_pieces"))).drop("_pieces")
