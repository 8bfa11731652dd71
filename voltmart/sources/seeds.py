"""Seed reference tables: from the fixed values, or from seed CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas as S

SEED_ROWS = {
    "emission_factors": C.EMISSION_FACTORS,
    "dim_concatchment_node": C.CATCHMENT_NODES,
    "dim_locations": C.LOCATIONS,
}


def seed(spark: SparkSession, name: str) -> tuple[DataFrame, int]:
    """(DataFrame, row count) of a built-in seed; the count bounds any broadcast."""
    rows = SEED_ROWS[name]
    return spark.createDataFrame(list(rows), S.SEEDS[name]), len(rows)


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Seed CSV with its declared schema, columns matched by header name; leading
    and trailing blanks in cells are ignored (one factor cell reads ' 200')."""
    schema = S.SEEDS[name]
    raw = (spark.read.option("header", True)
           .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
           .csv(path))
    typed = raw.select(*[F.trim(F.col(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return typed.where(F.col(schema.fields[0].name).isNotNull())
