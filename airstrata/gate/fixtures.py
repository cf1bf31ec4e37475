"""Air-quality inputs derived row by row from the ``events`` table.

``readings`` is the long table of hourly readings; ``documents`` turns every event into a
JSON document as a landed file would hold it, several of them for the same hour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.schemas import COORDINATE, POLLUTANTS

CODES = f"array({', '.join(repr(p.code) for p in POLLUTANTS)})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hours(step: int) -> str:
    """``ts`` cut down to a multiple of ``step`` hours, without passing through a time zone."""
    return (
        "make_timestamp_ntz(year(ts), month(ts), day(ts), "
        f"cast(hour(ts) div {step} * {step} as int), 0, 0)"
    )


def _code(number: str) -> str:
    return f"element_at({CODES}, cast({number} % {len(POLLUTANTS)} + 1 as int))"


# Ten stations in five cities and two states.
PLACE = """
    'WORLD' as country,
    concat('R_', user_id % 10 % 5 % 2) as state,
    concat('C', user_id % 10 % 5) as city,
    concat('S', user_id % 10) as station"""


def readings(spark: SparkSession, sf_dir: str, day: Column | None = None) -> DataFrame:
    """A reading of one pollutant every six hours, of all days or one.

    The day restricts the event time itself, so that its bounds reach the scan.
    """
    events = table(spark, sf_dir, "events")
    if day is not None:
        start, end = day.cast("timestamp_ntz"), F.date_add(day, 1).cast("timestamp_ntz")
        events = events.filter((F.col("ts") >= start) & (F.col("ts") < end))
    return spark.sql(
        f"""
        select {_hours(6)} as index_record_ts, {PLACE},
               cast(user_id % 10 as {COORDINATE.simpleString()}) as latitude,
               cast(user_id % 10 * 2 as {COORDINATE.simpleString()}) as longitude,
               {_code('event_id')} as pollutant_id,
               if(value < 2, 'NA', cast(floor(value) as string)) as pollutant_avg
        from {{events}}""",
        events=events,
    )


def last_update(ts: str) -> str:
    """SQL for the ``dd-MM-yyyy HH:mm:ss`` text of a zone-less timestamp."""
    text = f"cast({ts} as string)"
    day, month, year = f"substr({text}, 9, 2)", f"substr({text}, 6, 2)", f"substr({text}, 1, 4)"
    return f"concat({day}, '-', {month}, '-', {year}, ' ', substr({text}, 12, 8))"


def documents(spark: SparkSession, sf_dir: str, carry: Sequence[str] = ()) -> DataFrame:
    """A document per event with 0 to 3 records, in the shape the file source delivers.

    The hour is the key under which documents compete; the event time is the file time.
    ``carry`` keeps further columns of the events.
    """

    def record(i: int) -> str:
        # Later records carry another time: a document goes by its first record.
        time = last_update("ts" if i else _hours(1))
        return f"""struct({PLACE},
            cast(user_id % 10 as string) as latitude,
            user_id % 10 * 2 as longitude,
            {_code(f'(event_id + {i})')} as pollutant_id,
            cast(floor(value) + {i + 1} as string) as pollutant_max,
            floor(value) + {i} as pollutant_min,
            if(value < 2, 'NA', cast(floor(value) + {i} as string)) as pollutant_avg,
            {time} as last_update)"""

    records = f"slice(array({', '.join(map(record, range(3)))}), 1, cast(event_id % 4 as int))"
    return spark.sql(
        f"""
        select event_id,
               to_json(struct(event_id % 4 as total, '1.0' as version, {records} as records))
                 as value,
               concat('doc_', event_id) as file_name,
               ts as file_modification_time
               {''.join(f', {c}' for c in carry)}
        from {{events}}""",
        events=table(spark, sf_dir, "events"),
    )
