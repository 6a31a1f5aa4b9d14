"""The mediated schema and the mappings from both raw sources to it."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of the mediated record. The types are ours.
MEDIATED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("make", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("mileage", T.DoubleType()),
    T.StructField("fuel", T.StringType()),
    T.StructField("transmission", T.StringType()),
    T.StructField("drive", T.StringType()),
    T.StructField("body_type", T.StringType()),
    T.StructField("engine_cylinders", T.StringType()),
    T.StructField("engine_displacement", T.DoubleType()),
    T.StructField("state", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("vin", T.StringType()),
])

# Mediated column -> column of the raw source (None: constant null).
SOURCE_A = {
    "id": "listing_id",
    "make": "franchise_make",
    "model": "model_name",
    "year": "year",
    "price": "price",
    "mileage": "mileage",
    "fuel": "fuel_type",
    "transmission": "transmission",
    "drive": "wheel_system",
    "body_type": "body_type",
    "engine_cylinders": "engine_cylinders",
    "engine_displacement": "engine_displacement",
    "state": None,
    "description": "description",
    "vin": "vin",
}
SOURCE_B = {
    "id": "id",
    "make": "manufacturer",
    "model": "model",
    "year": "year",
    "price": "price",
    "mileage": "odometer",
    "fuel": "fuel",
    "transmission": "transmission",
    "drive": "drive",
    "body_type": "type",
    "engine_cylinders": "cylinders",
    "engine_displacement": None,
    "state": "state",
    "description": "description",
    "vin": "VIN",
}

# Columns of source A whose numeric moments are profiled.
PROFILED_NUMERIC = [
    "city_fuel_economy", "combine_fuel_economy", "daysonmarket", "dealer_zip",
    "engine_displacement", "highway_fuel_economy", "horsepower", "latitude", "longitude",
]

# Columns of source A whose exact distinct values are counted.
PROFILED_DISTINCT = [
    "vin", "back_legroom", "bed", "bed_height", "bed_length", "body_type", "cabin", "city",
    "description", "engine_cylinders", "engine_type", "exterior_color", "fleet",
    "frame_damaged", "franchise_dealer", "franchise_make", "front_legroom",
    "fuel_tank_volume", "fuel_type", "has_accidents", "height", "interior_color", "isCab",
    "is_certified", "is_cpo", "is_new", "is_oemcpo", "length", "listed_date",
    "listing_color", "listing_id", "main_picture_url",
]

# Limits and thresholds of the labelling, splitting and linking steps.
CANDIDATES_PER_BLOCK = 5
CAP_PER_LABEL = 200_000
SPLIT_PERCENT = (70, 15, 15)
SPLIT_SEED = 42
SAMPLE_SIZE = 3_000
MAX_DISTINCT_PAIRS = 5_000
TRIES_PER_PAIR = 10
LINK_THRESHOLD = 0.5
MODEL_SIMILARITY_THRESHOLD = 0.90
YEAR_SCALE = 5
MILEAGE_BIN_SCALE = 2
MILEAGE_BIN_WIDTH = 10_000
HLL_LG_K = 12
PREVIEW_ROWS = 10
TOP_ROWS = 50
