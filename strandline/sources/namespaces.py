"""Databases of the lakehouse layers."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Layer names.
LAYERS = ("bronze", "silver", "gold", "data_quality_check")


def create_namespaces(spark: SparkSession, root: str, prefix: str = "") -> list[str]:
    """One database per layer, each with its own folder under ``root``."""
    names = [f"{prefix}{layer}" for layer in LAYERS]
    for layer, name in zip(LAYERS, names):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{root}/{layer}'")
    return names
