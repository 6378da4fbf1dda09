"""Railway stations from the nested station feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railctx.functions.keys import eva_key, false_if_null

STATION_OBJECT = """
    number bigint,
    name string,
    category int,
    priceCategory int,
    federalState string,
    regionalbereich struct<name: string>,
    evaNumbers array<struct<
        number: bigint,
        isMain: boolean,
        geographicCoordinates: struct<type: string, coordinates: array<double>>
    >>,
    ril100Identifiers array<struct<rilIdentifier: string, isMain: boolean>>
"""


def station_objects(raw: DataFrame) -> DataFrame:
    """Station objects from a parsed table or from one JSON text per row in ``value``."""
    if "value" in raw.columns and "evaNumbers" not in raw.columns:
        return raw.select(F.from_json("value", STATION_OBJECT).alias("object")).select("object.*")
    return raw


def stations(raw: DataFrame) -> DataFrame:
    """One row per EVA number; the feed lists coordinates as longitude, latitude."""
    per_eva = station_objects(raw).withColumn("eva", F.explode_outer("evaNumbers"))
    place = F.col("eva.geographicCoordinates.coordinates")
    flat = per_eva.select(
        eva_key(F.col("eva.number")).alias("eva"),
        F.col("number").alias("station_number"),
        F.col("name").alias("station_name"),
        F.get("ril100Identifiers", F.lit(0))["rilIdentifier"].alias("ds100"),
        F.col("category").cast("int").alias("category"),
        F.col("priceCategory").cast("int").alias("price_category"),
        F.col("federalState").alias("federal_state"),
        F.col("regionalbereich.name").alias("regional_bereich"),
        F.get(place, F.lit(1)).alias("latitude"),
        F.get(place, F.lit(0)).alias("longitude"),
        false_if_null(F.col("eva.isMain")).alias("is_main_eva"),
    )
    return flat.where(F.col("eva").isNotNull())
