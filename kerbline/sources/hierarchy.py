"""Nested hierarchy documents to bridge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bridge_of(documents: DataFrame) -> DataFrame:
    """(tier, json of {entity: {counties: [...]}}) -> tier, entity, fips."""
    entities = F.from_json("json", "map<string, struct<counties: array<int>>>")
    rows = documents.select("tier", F.explode(entities).alias("entity", "e"))
    return rows.select("tier", "entity", F.explode("e.counties").alias("fips"))
