from clickpath.sources.changes import restated_days, source_files, source_log
from clickpath.sources.exports import read_events, read_shards, read_table
from clickpath.sources.sample import sample_events

__all__ = ["read_events", "read_shards", "read_table", "restated_days", "sample_events", "source_files", "source_log"]
