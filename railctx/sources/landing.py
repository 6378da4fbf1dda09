"""Where the raw files of a period lie."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import SparkSession

from railctx.period import Period

BASE_SETTING = "railctx.landing"
BASE_VARIABLE = "RAILCTX_LANDING"
BASE_DEFAULT = "landing"


@dataclass(frozen=True)
class LandingPaths:
    station_json: str
    temperature_listing: str
    wind_listing: str
    temperature_files: str
    wind_files: str
    stops: str
    #: Archived responses that the station file was made from.
    station_archive: str = ""
    #: The folder itself, with the manifest.
    base: str = ""

    @classmethod
    def under(cls, base: str, period: Period) -> LandingPaths:
        """The fixed file layout below one folder."""
        root = base.rstrip("/")
        return cls(
            station_json=f"{root}/stada/stada_stations.json",
            temperature_listing=f"{root}/dwd/metadata/TU_Stundenwerte_Beschreibung_Stationen.txt",
            wind_listing=f"{root}/dwd/metadata/FF_Stundenwerte_Beschreibung_Stationen.txt",
            temperature_files=f"{root}/dwd/temperature/*.txt",
            wind_files=f"{root}/dwd/wind/*.txt",
            stops=f"{root}/railway/data-{period.label}.parquet",
            station_archive=f"{root}/stada/responses-{period.label}.parquet",
            base=root,
        )

    @classmethod
    def resolve(cls, spark: SparkSession, period: Period, base: str | None = None) -> LandingPaths:
        """Explicit folder, else the session setting, else the environment, else the default."""
        if base is None:
            base = spark.conf.get(BASE_SETTING, None)
        if base is None:
            base = os.environ.get(BASE_VARIABLE, BASE_DEFAULT)
        return cls.under(base, period)
