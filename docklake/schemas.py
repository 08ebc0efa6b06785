"""Schemas of the tables, as DDL strings."""

RAW_SNAPSHOT = "datasource string, timestamp_ms bigint, key string, content string"

KAFKA_MESSAGE = "topic string, key string, value string"

# Every leaf is read as text; typing and defaults are applied afterwards.
SNAPSHOT_XML = (
    "updatetime string, station array<struct<"
    "id:string, lat:string, long:string, street:string, height:string, streetNumber:string, "
    "nearbyStationList:string, status:string, slots:string, bikes:string>>"
)

OBSERVATION = (
    "updatetime bigint, timetag timestamp, station int, latitude double, longitude double, "
    "street string, height int, street_number int, nearby array<int>, status string, slots int, bikes int"
)

STATION_DIM = (
    "id bigint, longitude double, latitude double, heigh bigint, district string, neighborhood string, "
    "postal_code string, address string, pop_density double, population bigint, size double"
)

TIME_DIM_COLUMNS = (
    "timetag", "minute", "hour", "daysixth", "part", "month_day", "year_day",
    "month_week", "year_week", "month", "trimester", "year",
)

FACT_COLUMNS = (
    "station", "timetag", "status", "slots", "available", "capacity", "lent", "returned",
)

BIG_TABLE_COLUMNS = FACT_COLUMNS + (
    "traffic", "district", "neighborhood", "postal_code", "address", "pop_density", "population",
    "size", "pop_density_range", "pop_range", "size_range",
) + TIME_DIM_COLUMNS[1:]

CURRENT_STATE = "longitude double, latitude double, the_geom string, status string, num_available_bikes int"

# The path of a month: "last month" is then found and read by partition alone.
MONTH_PARTITIONS = ("year", "trimester", "month")
