"""Small lookup tables shipped with the package, and the typed reader for replacements."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from countypanel import schemas

# State code, name, abbreviation, Census region, Census division and the
# year Medicaid expansion took effect (None where it has not).
STATES = [
    ("01", "Alabama", "AL", "South", "East South Central", None),
    ("02", "Alaska", "AK", "West", "Pacific", 2015),
    ("04", "Arizona", "AZ", "West", "Mountain", 2014),
    ("05", "Arkansas", "AR", "South", "West South Central", 2014),
    ("06", "California", "CA", "West", "Pacific", 2014),
    ("08", "Colorado", "CO", "West", "Mountain", 2014),
    ("09", "Connecticut", "CT", "Northeast", "New England", 2014),
    ("10", "Delaware", "DE", "South", "South Atlantic", 2014),
    ("11", "District of Columbia", "DC", "South", "South Atlantic", 2014),
    ("12", "Florida", "FL", "South", "South Atlantic", None),
    ("13", "Georgia", "GA", "South", "South Atlantic", None),
    ("15", "Hawaii", "HI", "West", "Pacific", 2014),
    ("16", "Idaho", "ID", "West", "Mountain", 2020),
    ("17", "Illinois", "IL", "Midwest", "East North Central", 2014),
    ("18", "Indiana", "IN", "Midwest", "East North Central", 2015),
    ("19", "Iowa", "IA", "Midwest", "West North Central", 2014),
    ("20", "Kansas", "KS", "Midwest", "West North Central", None),
    ("21", "Kentucky", "KY", "South", "East South Central", 2014),
    ("22", "Louisiana", "LA", "South", "West South Central", 2016),
    ("23", "Maine", "ME", "Northeast", "New England", 2019),
    ("24", "Maryland", "MD", "South", "South Atlantic", 2014),
    ("25", "Massachusetts", "MA", "Northeast", "New England", 2014),
    ("26", "Michigan", "MI", "Midwest", "East North Central", 2014),
    ("27", "Minnesota", "MN", "Midwest", "West North Central", 2014),
    ("28", "Mississippi", "MS", "South", "East South Central", None),
    ("29", "Missouri", "MO", "Midwest", "West North Central", 2021),
    ("30", "Montana", "MT", "West", "Mountain", 2016),
    ("31", "Nebraska", "NE", "Midwest", "West North Central", 2020),
    ("32", "Nevada", "NV", "West", "Mountain", 2014),
    ("33", "New Hampshire", "NH", "Northeast", "New England", 2014),
    ("34", "New Jersey", "NJ", "Northeast", "Middle Atlantic", 2014),
    ("35", "New Mexico", "NM", "West", "Mountain", 2014),
    ("36", "New York", "NY", "Northeast", "Middle Atlantic", 2014),
    ("37", "North Carolina", "NC", "South", "South Atlantic", 2023),
    ("38", "North Dakota", "ND", "Midwest", "West North Central", 2014),
    ("39", "Ohio", "OH", "Midwest", "East North Central", 2014),
    ("40", "Oklahoma", "OK", "South", "West South Central", 2021),
    ("41", "Oregon", "OR", "West", "Pacific", 2014),
    ("42", "Pennsylvania", "PA", "Northeast", "Middle Atlantic", 2015),
    ("44", "Rhode Island", "RI", "Northeast", "New England", 2014),
    ("45", "South Carolina", "SC", "South", "South Atlantic", None),
    ("46", "South Dakota", "SD", "Midwest", "West North Central", 2023),
    ("47", "Tennessee", "TN", "South", "East South Central", None),
    ("48", "Texas", "TX", "South", "West South Central", None),
    ("49", "Utah", "UT", "West", "Mountain", 2020),
    ("50", "Vermont", "VT", "Northeast", "New England", 2014),
    ("51", "Virginia", "VA", "South", "South Atlantic", 2019),
    ("53", "Washington", "WA", "West", "Pacific", 2014),
    ("54", "West Virginia", "WV", "South", "South Atlantic", 2014),
    ("55", "Wisconsin", "WI", "Midwest", "East North Central", None),
    ("56", "Wyoming", "WY", "West", "Mountain", None),
]

# Policy eras with inclusive first and last year and chart color.
ERAS = [
    ("Trump1", "Trump", 2017, 2020, "#e31a1c"),
    ("Biden", "Biden", 2021, 2024, "#1f78b4"),
    ("Trump2", "Trump", 2025, 2027, "#fc8d59"),
]

ERA_ORDER = [era[0] for era in ERAS]
ERA_SPANS = [(era[0], era[2], era[3]) for era in ERAS]


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A literal table whose exact size Spark knows, so it joins by broadcast without a hint."""
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def states(spark: SparkSession) -> DataFrame:
    return local_table(spark, [row[:5] for row in STATES], schemas.SEED_STATES)


def expansion(spark: SparkSession) -> DataFrame:
    rows = [
        (fips, name, abbr, "not_expanded" if year is None else "expanded", year)
        for fips, name, abbr, _, _, year in STATES
    ]
    return local_table(spark, rows, schemas.SEED_EXPANSION)


def eras(spark: SparkSession) -> DataFrame:
    return local_table(spark, ERAS, schemas.SEED_ERAS)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Seed CSV with pinned types, so that code ``01`` stays text; blank fields are null."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
