"""Index functions and questions for SQL users, as SQL-bodied functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from airstrata.schemas import DATE_PARTITION, LABELS, MEASURES

# Fixed parameter names of the SQL functions.
PARAMETERS = ("pm25", "pm10", "so2", "no2", "nh3", "co", "o3")


def register_sql(spark: SparkSession) -> None:
    """Create ``prominent_index``, ``three_sub_index_criteria`` and ``aqi_value``."""
    signature = ", ".join(f"{name} DOUBLE" for name in PARAMETERS)
    filled = [f"coalesce({name}, 0)" for name in PARAMETERS]
    branches = " ".join(f"WHEN {v} THEN '{label}'" for v, label in zip(filled, LABELS))
    gases = " + ".join(f"if({gas} <> 0, 1, 0)" for gas in PARAMETERS[2:])
    arguments = ", ".join(PARAMETERS)

    def create(name: str, result: str, body: str) -> None:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({signature}) RETURNS {result} RETURN {body}"
        )

    create("prominent_index", "STRING", f"CASE greatest({', '.join(filled)}) {branches} END")
    create(
        "three_sub_index_criteria",
        "INT",
        f"if(pm25 > 0 OR pm10 > 0, 1, 0) + least(2, {gases})",
    )
    create(
        "aqi_value",
        "DOUBLE",
        f"if(three_sub_index_criteria({arguments}) > 2, greatest({arguments}), 0)",
    )


# Where the questions look, and the day by which these tables are partitioned.
GOLD = {
    "hours": "gold.fact_city_agg_hour_level",
    "days": "gold.fact_city_agg_day_level",
    "fact": "gold.fact_air_quality",
    "dates": "gold.dim_date",
    "locations": "gold.dim_location",
}


def register_questions(spark: SparkSession, **tables: str) -> None:
    """Create the parameterized questions as table functions of the session.

    ``top_cities_latest_day(k)``, ``city_hourly_trend(state, city, day)``,
    ``city_hour_at(city, at)`` and ``station_drilldown(state, city, station, day)`` have the
    columns of the functions of the same purpose in ``consume``; rows come in no order. They
    read the tables that ``Lake.register`` makes, or those named by the keys of ``GOLD``.
    Bodies are inlined, so a question about a day reads one partition. Spark calls table
    functions by a plain name, so they belong to the session and not to a schema.
    """
    at = GOLD | tables
    means = ", ".join(MEASURES)
    kinds = ", ".join(f"{m} DOUBLE" for m in MEASURES)
    place = "state STRING, city STRING"

    def create(name: str, parameters: str, result: str, body: str) -> None:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
            f"RETURNS TABLE ({result}) RETURN {body}"
        )

    create(
        "top_cities_latest_day",
        "k INT",
        f"{place}, {kinds}, prominent_pollutant STRING, aqi DOUBLE",
        f"""SELECT state, city, {means}, prominent_pollutant, aqi FROM (
            SELECT *, row_number() OVER (ORDER BY aqi DESC, state, city) AS place
            FROM {at['days']}
            WHERE {DATE_PARTITION} = (SELECT max({DATE_PARTITION}) FROM {at['days']})
        ) WHERE place <= k""",
    )
    create(
        "city_hourly_trend",
        "of_state STRING, of_city STRING, day DATE",
        f"hour INT, {kinds}",
        f"""SELECT hour(measurement_time), {means} FROM {at['hours']}
        WHERE {DATE_PARTITION} = day AND state = of_state AND city = of_city""",
    )
    create(
        "city_hour_at",
        "of_city STRING, at TIMESTAMP_NTZ",
        f"measurement_time TIMESTAMP_NTZ, country STRING, {place}, {kinds}, "
        "prominent_pollutant STRING, aqi DOUBLE",
        f"""SELECT measurement_time, country, state, city, {means}, prominent_pollutant, aqi
        FROM {at['hours']}
        WHERE {DATE_PARTITION} = to_date(at) AND measurement_time = at AND city = of_city""",
    )
    create(
        "station_drilldown",
        "of_state STRING, of_city STRING, of_station STRING, day DATE",
        f"hour INT, {place}, station STRING, latitude DECIMAL(10,7), longitude DECIMAL(10,7), "
        f"{kinds}, prominent_pollutant STRING, aqi DOUBLE",
        f"""SELECT hour(d.measurement_time), l.state, l.city, l.station,
            CAST(l.latitude AS DECIMAL(10,7)), CAST(l.longitude AS DECIMAL(10,7)), {means},
            f.prominent_pollutant, f.aqi
        FROM {at['fact']} f JOIN {at['dates']} d ON f.date_fk = d.date_pk
        JOIN {at['locations']} l ON f.location_fk = l.location_pk
        WHERE f.{DATE_PARTITION} = day AND d.{DATE_PARTITION} = day AND l.state = of_state
          AND l.city = of_city AND l.station = of_station""",
    )
