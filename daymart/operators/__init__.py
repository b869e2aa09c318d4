"""DataFrame operators: DataFrames in, DataFrames out."""

from daymart.operators.clean import clean_events, validate_events
from daymart.operators.series import integrate, keyed_replace, unzip_daily, within_days
from daymart.operators.keys import dense_keys, expand_rows, rank_tuples
from daymart.operators.lookup import broadcast_if_small, lookup_key, stored_bytes
from daymart.operators.colocate import co_locate, key_places
from daymart.operators.scratch import clear_scratch, settle

__all__ = [
    "broadcast_if_small",
    "clean_events",
    "clear_scratch",
    "co_locate",
    "dense_keys",
    "expand_rows",
    "integrate",
    "key_places",
    "keyed_replace",
    "lookup_key",
    "rank_tuples",
    "settle",
    "stored_bytes",
    "unzip_daily",
    "validate_events",
    "within_days",
]
