"""Paths under one data root."""

from __future__ import annotations


def data_path(root: str, relative: str) -> str:
    """Join with exactly one slash between root and relative path."""
    return f"{root.rstrip('/')}/{relative.lstrip('/')}"


def table_path(root: str, table: str) -> str:
    """Where a modelled table lives under the root."""
    if table.startswith(("map_", "stg_")):
        folder = "stage"
    elif table.startswith(("dim_", "fact_")):
        folder = "dashboard_mart/kimball_star"
    else:
        folder = "dashboard_mart"
    return data_path(root, f"{folder}/{table}.parquet")
