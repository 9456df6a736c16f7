"""Declared schemas of the input tables and stream records.

Column names and types are fixed values: they are those of the public files.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructType, TimestampNTZType, TimestampType,
)

_TYPES = {
    "int": IntegerType(), "long": LongType(), "double": DoubleType(), "string": StringType(),
    "timestamp": TimestampType(), "timestamp_ntz": TimestampNTZType(),
}


def ddl(text: str) -> StructType:
    """Schema from ``name type, ...``; unlike ``fromDDL`` it needs no session."""
    schema = StructType()
    for field in text.split(","):
        name, kind = field.split()
        schema = schema.add(name, _TYPES[kind])
    return schema


GREEN_TRIPS = ddl("""
    VendorID int, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp,
    store_and_fwd_flag string, RatecodeID int, PULocationID int, DOLocationID int,
    passenger_count int, trip_distance double, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, ehail_fee double,
    improvement_surcharge double, total_amount double, payment_type int, trip_type int,
    congestion_surcharge double
""")

YELLOW_TRIPS = ddl("""
    VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,
    passenger_count int, trip_distance double, RatecodeID int, store_and_fwd_flag string,
    PULocationID int, DOLocationID int, payment_type int, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double, congestion_surcharge double
""")

FHVHV_TRIPS = ddl("""
    hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp,
    dropoff_datetime timestamp, PULocationID int, DOLocationID int, SR_Flag string
""")

FHV_TRIPS = ddl("""
    dispatching_base_num string, affiliated_base_number string, pickup_datetime timestamp,
    dropoff_datetime timestamp, pulocationid int, dolocationid int, sr_flag string
""")

ZONES = ddl("LocationID int, Borough string, Zone string, service_zone string")

PAYMENT_LOOKUP = ddl("payment_type_id int, payment_type_name string")

GAME = ddl("""
    game_id string, season_id string, game_date string,
    team_id_home long, team_abbreviation_home string, team_name_home string,
    wl_home string, pts_home long,
    team_id_away long, team_abbreviation_away string, team_name_away string,
    wl_away string, pts_away long
""")

GAME_INFO = ddl("game_id string, attendance long, game_time string")

# What the two ingest variants hand to staging.
INGESTED_TRIPS = ddl("""
    pickup_datetime timestamp, dropoff_datetime timestamp, passenger_count int,
    trip_distance double, fare_amount double, payment_type int, taxi_type string,
    extracted_at timestamp
""")

INGESTED_TRIPS_LOCATED = ddl("""
    pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id int,
    dropoff_location_id int, fare_amount double, payment_type int, taxi_type string
""")

# JSON records on the topics.
RIDE = ddl("""
    PULocationID int, DOLocationID int, trip_distance double, total_amount double,
    tpep_pickup_datetime long
""")

GREEN_RIDE = ddl("""
    lpep_pickup_datetime string, lpep_dropoff_datetime string, PULocationID int,
    DOLocationID int, passenger_count double, trip_distance double, tip_amount double,
    total_amount double
""")
