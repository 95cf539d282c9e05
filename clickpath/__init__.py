"""Web-analytics events to sessions, attribution and revenue reports on Spark."""

from clickpath.operators import *  # noqa: F403
from clickpath.operators import __all__ as _operators
from clickpath.plans import daily_refresh, full_refresh
from clickpath.session import SETTINGS, build_session
from clickpath.sinks import Warehouse
from clickpath.sinks.audit import KeyViolation, violations
from clickpath.sources import read_events, read_shards, read_table, source_files, source_log

__all__ = [
    *_operators,
    "KeyViolation",
    "SETTINGS",
    "Warehouse",
    "build_session",
    "daily_refresh",
    "full_refresh",
    "read_events",
    "read_shards",
    "read_table",
    "source_files",
    "source_log",
    "violations",
]
