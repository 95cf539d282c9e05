"""Traffic source of one event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL tag pattern and, per output, the parameter key and the campaign field.
URL_TAG = "[?&]utm_{tag}=([^&]+)"
TRAFFIC_FIELDS = {
    "source": "source",
    "medium": "medium",
    "campaign": "campaign_name",
}


def url_tag(url: Column, tag: str) -> Column:
    """Value of a campaign tag in a URL as written there, NULL when absent.

    The first element of all matches is NULL on no match, where ``regexp_extract`` gives
    an empty string. Most URLs carry no tag; the substring test spares them the search.
    """
    matches = F.regexp_extract_all(url, F.lit(URL_TAG.format(tag=tag)), F.lit(1))
    return F.when(F.contains(url, F.lit(f"utm_{tag}=")), F.get(matches, F.lit(0)))


def traffic(field: str, url: Column, param: Column) -> Column:
    """First of: URL tag, event parameter, collected campaign, last click of the session.

    Only NULL falls through; an empty string is a value.
    """
    name = TRAFFIC_FIELDS[field]
    return F.coalesce(
        url_tag(url, field),
        param,
        F.col(f"collected_traffic_source.manual_campaign.{name}"),
        F.col(f"session_traffic_source_last_click.manual_campaign.{name}"),
    )
