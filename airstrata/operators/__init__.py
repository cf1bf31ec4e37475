from airstrata.operators.checks import key_uniqueness
from airstrata.operators.dedup import keep_latest_rows, latest_per_key, not_yet_loaded
from airstrata.operators.rank import rank_within_key
from airstrata.operators.reshape import flatten_records, pivot_long_to_wide
from airstrata.operators.rollup import member_dates, members, rollup_avg
from airstrata.operators.sizing import broadcast_if_small
from airstrata.operators.skew import HeavyKeys, heavy_keys, spread_join
from airstrata.operators.star import star_join

__all__ = [
    "HeavyKeys",
    "broadcast_if_small",
    "flatten_records",
    "heavy_keys",
    "keep_latest_rows",
    "key_uniqueness",
    "latest_per_key",
    "member_dates",
    "members",
    "not_yet_loaded",
    "pivot_long_to_wide",
    "rank_within_key",
    "rollup_avg",
    "spread_join",
    "star_join",
]
