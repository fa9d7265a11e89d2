"""Explicit schemas. Field names and types are fixed values of the data they describe."""

from __future__ import annotations

# Event feeds, as JSON lines. ``location`` is a JSON array kept as text.
FEEDS = {
    "vehicle": "id STRING, deviceId STRING, timestamp TIMESTAMP, location STRING, speed DOUBLE, "
    "direction STRING, make STRING, model STRING, year INT, fuelType STRING",
    "gps": "id STRING, deviceId STRING, timestamp TIMESTAMP, speed DOUBLE, direction STRING, "
    "vehicleType STRING",
    "traffic": "id STRING, deviceId STRING, camera_id STRING, location STRING, "
    "timestamp TIMESTAMP, snapshot STRING",
    "weather": "id STRING, deviceId STRING, timestamp TIMESTAMP, location STRING, "
    "temperature DOUBLE, weatherCondition STRING, precipitation DOUBLE, windSpeed DOUBLE, "
    "humidity INT, airQualityIndex DOUBLE",
    "emergency": "id STRING, deviceId STRING, incidentId STRING, type STRING, "
    "timestamp TIMESTAMP, location STRING, status STRING, description STRING",
}

# Store tables, as hourly CSV deltas.
STORE = {
    "users": "id INT, name STRING, email STRING, phone STRING, created_at TIMESTAMP, "
    "updated_at TIMESTAMP",
    "orders": "id INT, user_id INT, is_refund BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP",
    "order_item": "id INT, order_id INT, goods_id INT, qty INT, created_at TIMESTAMP, "
    "updated_at TIMESTAMP",
    "goods": "id INT, category_id INT, name STRING, price DOUBLE, created_at TIMESTAMP, "
    "updated_at TIMESTAMP",
    "categories": "id INT, name STRING, created_at TIMESTAMP, updated_at TIMESTAMP",
}

# Rules for the store tables: every column must be filled, and ``id`` must be unique.
STORE_RULES = {name: ([f.split()[0] for f in fields.split(", ")], ["id"]) for name, fields in STORE.items()}

# What really identifies a row: item ids restart with every hourly file.
STORE_KEYS = {
    "users": ["id"],
    "orders": ["id"],
    "order_item": ["order_id", "id"],
    "goods": ["id"],
    "categories": ["id"],
}

TRIPS = (
    "VendorID BIGINT, lpep_pickup_datetime TIMESTAMP, lpep_dropoff_datetime TIMESTAMP, "
    "store_and_fwd_flag STRING, RatecodeID BIGINT, PULocationID BIGINT, DOLocationID BIGINT, "
    "passenger_count BIGINT, trip_distance DOUBLE, fare_amount DOUBLE, extra DOUBLE, "
    "mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE, ehail_fee DOUBLE, "
    "improvement_surcharge DOUBLE, total_amount DOUBLE, payment_type BIGINT, trip_type BIGINT, "
    "congestion_surcharge DOUBLE"
)

MOVIES = (
    "id STRING, imdb_id STRING, popularity STRING, budget STRING, revenue STRING, "
    "original_title STRING, cast STRING, homepage STRING, director STRING, tagline STRING, "
    "keywords STRING, overview STRING, runtime STRING, genres STRING, "
    "production_companies STRING, release_date STRING, vote_count STRING, "
    "vote_average STRING, release_year STRING, budget_adj STRING, revenue_adj STRING"
)

PRODUCTS = (
    "id BIGINT, name STRING, url_key STRING, price BIGINT, description STRING, images ARRAY<STRING>"
)
EPISODES = "link STRING, title STRING, pubDate STRING, description STRING"
