"""The models: DataFrame in, DataFrame out."""

from clickpath.operators.attribution import (
    first_click,
    first_click_from_pre,
    last_non_direct,
    last_non_direct_from_pre,
    linear,
    linear_by_source,
)
from clickpath.operators.events import (
    event_params_lookup,
    pre_events,
    pre_events_day,
    pre_events_recent,
    pre_events_since,
    traffic_cascade,
)
from clickpath.operators.identity import unified_id
from clickpath.operators.incremental import pre_events_incremental, pre_sessions_incremental, upsert_sessions
from clickpath.operators.reports import (
    products,
    products_session_scope,
    products_split,
    transactions,
    transactions_session_scope,
    transactions_split,
)
from clickpath.operators.sessions import pre_sessions, recent_sessions, sessions

__all__ = [
    "event_params_lookup",
    "first_click",
    "first_click_from_pre",
    "last_non_direct",
    "last_non_direct_from_pre",
    "linear",
    "linear_by_source",
    "pre_events",
    "pre_events_day",
    "pre_events_incremental",
    "pre_events_recent",
    "pre_events_since",
    "pre_sessions",
    "pre_sessions_incremental",
    "products",
    "products_session_scope",
    "products_split",
    "recent_sessions",
    "sessions",
    "traffic_cascade",
    "transactions",
    "transactions_session_scope",
    "transactions_split",
    "unified_id",
    "upsert_sessions",
]
