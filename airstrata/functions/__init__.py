from airstrata.functions.index import (
    aqi_value,
    argmax_label,
    capped_count,
    criteria,
    prominent_index,
    qualified_max,
)
from airstrata.functions.keys import surrogate_key
from airstrata.functions.sql import register_questions, register_sql
from airstrata.functions.text import clean_numeric, parse_ts

__all__ = [
    "aqi_value",
    "argmax_label",
    "capped_count",
    "clean_numeric",
    "criteria",
    "parse_ts",
    "prominent_index",
    "qualified_max",
    "register_questions",
    "register_sql",
    "surrogate_key",
]
