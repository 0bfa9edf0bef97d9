"""Metadata extracts: the column catalog and the primary keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegate.operators.joins import primary_keys
from tidegate.operators.slices import catalog_slice
from tidegate.sources.tables import scan_projected

TEXT_TYPE = "VARCHAR2"  # fixed value: the type that separates the two slices


def read_catalog_columns(
    columns: DataFrame,
    owner: str,
    part: int | None = None,
    return_fields: str | None = None,
    text_type: str = TEXT_TYPE,
) -> DataFrame:
    """One slice of the column catalog, or both when ``part`` is None."""
    sliced = catalog_slice(columns, owner, part, text_type)
    return scan_projected(sliced, return_fields) if return_fields else sliced


def read_primary_keys(constraints: DataFrame, cons_columns: DataFrame, owner: str) -> DataFrame:
    return primary_keys(constraints, cons_columns, owner)
