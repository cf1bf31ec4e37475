"""Joining the fact to its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.operators.skew import HeavyKeys, spread_join


def star_join(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_location: DataFrame,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Fact rows with the columns of both dimensions, by inner joins on the hash keys.

    A location key that occurs twice (two stations on one coordinate) doubles its facts, as
    in the original model; ``key_uniqueness`` finds such keys. There is no broadcast hint:
    stored dimensions are broadcast by their file size, computed ones by what AQE measures,
    and a dimension above the threshold is joined by a shuffle with skew handling.

    Skew handling starts at a size of partitions and splits what has been shuffled to one task.
    Where the location dimension is too large to be broadcast and a coordinate may hold a
    large part of the facts, pass ``heavy_keys(fact, "location_fk")``: the facts of heavy
    coordinates are then dealt into pieces before the shuffle.
    """
    dated = fact.join(dim_date, F.col("date_fk") == F.col("date_pk"))
    if heavy is None:
        return dated.join(dim_location, F.col("location_fk") == F.col("location_pk"))
    return spread_join(dated, dim_location, "location_fk", "location_pk", heavy)
