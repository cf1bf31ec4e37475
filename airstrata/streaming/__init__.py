from airstrata.streaming.compaction import compact
from airstrata.streaming.freshness import freshness
from airstrata.streaming.ingest import load_batch, load_inserted, start_ingest
from airstrata.streaming.refresh import refresh_all, refresh_dates, refresh_order, refresh_pending

__all__ = [
    "compact",
    "freshness",
    "load_batch",
    "load_inserted",
    "refresh_all",
    "refresh_dates",
    "refresh_order",
    "refresh_pending",
    "start_ingest",
]
