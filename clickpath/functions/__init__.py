"""Column expressions on built-in functions; ``farm_fingerprint`` alone works on Arrow batches."""

from clickpath.functions.farm import farm_fingerprint
from clickpath.functions.keys import event_id, farm_event_id, fingerprint_event_id, params_json, session_key
from clickpath.functions.ordering import earliest, latest, nulls_last_key
from clickpath.functions.params import event_param
from clickpath.functions.traffic import traffic, url_tag

__all__ = [
    "earliest",
    "event_id",
    "event_param",
    "farm_event_id",
    "farm_fingerprint",
    "fingerprint_event_id",
    "latest",
    "nulls_last_key",
    "params_json",
    "session_key",
    "traffic",
    "url_tag",
]
