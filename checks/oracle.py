"""The same results in DuckDB SQL, written by hand over the given ``events`` table.

Each check is a chain of the steps below ending in one SELECT. The steps are plain SQL
over rows and windows; nothing here is generated from the Spark code.
"""

from __future__ import annotations

from checks import farm

# The raw log, as clickpath.sources.sample defines it.
RAW = """
src as (
    select *, cast(json_extract_string(props, '$.k') as integer) as k, epoch_us(ts) as us
    from events
),
raw as (
    select
        strftime(ts, '%Y%m%d') as event_date,
        us as event_timestamp,
        event_type as event_name,
        case when user_id % 50 <> 49 then 'c' || user_id end as user_pseudo_id,
        case when k % 4 = 0 then 'crm' || user_id
             when k % 4 = 1 and user_id % 5 = 0 then 'crm_alt' || user_id end as user_id,
        event_id as bundle,
        cast(k * 1000 as bigint) as server_offset,
        list_filter([
            case when k % 17 <> 0 then {'key': 'ga_session_id', 's': cast(null as varchar), 'i': us // 259200000000} end,
            {'key': 'page_location',
             's': 'https://shop.example/p/' || k || case k % 6
                    when 0 then '?utm_source=google&utm_medium=cpc&utm_campaign=c' || (k % 3)
                    when 1 then '?ref=x&utm_source=news'
                    else '' end,
             'i': cast(null as bigint)},
            case when k % 6 = 1 then {'key': 'source', 's': 'ignored', 'i': cast(null as bigint)} end,
            case when k % 6 = 1 then {'key': 'medium', 's': 'email', 'i': cast(null as bigint)} end,
            case when k % 6 = 2 then {'key': 'source', 's': '(direct)', 'i': cast(null as bigint)} end,
            case when k % 6 = 2 then {'key': 'medium', 's': '(none)', 'i': cast(null as bigint)} end
        ], lambda p: p is not null) as params,
        case when k % 6 = 3 then {'source': 'bing', 'medium': 'organic', 'name': cast(null as varchar)} end as collected,
        case when k % 6 = 4 then {'source': 'partner', 'medium': 'referral', 'name': 'spring'} end as last_click,
        case when event_type = 'purchase' and k % 13 <> 0 then 'T' || event_id end as transaction_id,
        case when event_type = 'purchase' then value end as purchase_revenue,
        case when event_type = 'purchase' then value * cast(0.25 as double) end as tax,
        case when event_type = 'purchase' then value * cast(0.125 as double) end as shipping,
        case when event_type = 'purchase' then list_transform(range(1, k % 4 + 1), lambda i: {
            'item_id': 'sku' || ((k + i) % 20),
            'item_name': 'Item ' || ((k + i) % 20),
            'item_category': 'cat' || (i % 3),
            'price': value * cast(0.5 as double),
            'quantity': i,
            'item_revenue': case when i % 2 = 0 then value * cast(0.75 as double) end
        }) end as items
    from src
)"""

LOOKED_UP = """
looked_up as (
    select *,
        list_filter(params, lambda p: p.key = 'ga_session_id')[1].i as ga_session_id,
        list_filter(params, lambda p: p.key = 'page_location')[1].s as page_location,
        list_filter(params, lambda p: p.key = 'campaign')[1].s as param_campaign,
        list_filter(params, lambda p: p.key = 'source')[1].s as param_source,
        list_filter(params, lambda p: p.key = 'medium')[1].s as param_medium
    from raw
)"""

FLAT = """
flat as (
    select
        user_pseudo_id || event_timestamp || event_name || bundle || server_offset as event_id,
        cast(strptime(event_date, '%Y%m%d') as date) as event_date,
        event_timestamp, event_name, user_pseudo_id, user_id, ga_session_id,
        user_pseudo_id || ga_session_id as session_key,
        coalesce(nullif(regexp_extract(page_location, '[?&]utm_source=([^&]+)', 1), ''),
                 param_source, collected.source, last_click.source) as fixed_traffic_source,
        coalesce(nullif(regexp_extract(page_location, '[?&]utm_medium=([^&]+)', 1), ''),
                 param_medium, collected.medium, last_click.medium) as fixed_traffic_medium,
        coalesce(nullif(regexp_extract(page_location, '[?&]utm_campaign=([^&]+)', 1), ''),
                 param_campaign, collected.name, last_click.name) as fixed_traffic_campaign,
        transaction_id, purchase_revenue, tax, shipping, items, params
    from looked_up
)"""

# One row per session.
ROLLED = """
rolled as (
    select distinct session_key, user_pseudo_id, ga_session_id,
        min(event_timestamp) over whole as session_start_timestamp,
        first_value(fixed_traffic_source ignore nulls) over path as session_first_source,
        first_value(fixed_traffic_medium ignore nulls) over path as session_first_medium,
        last_value(fixed_traffic_source ignore nulls) over path as session_last_source,
        last_value(fixed_traffic_medium ignore nulls) over path as session_last_medium
    from flat
    where ga_session_id is not null
    window whole as (partition by session_key, user_pseudo_id, ga_session_id),
           path as (partition by session_key, user_pseudo_id, ga_session_id
                    order by event_timestamp asc nulls last, fixed_traffic_source asc nulls last,
                             fixed_traffic_medium asc nulls last
                    rows between unbounded preceding and unbounded following)
)"""

# One row per session, source, medium and event time; first and last over the session key.
ROLLED_BY_EVENT = """
moments as (
    select distinct session_key, user_pseudo_id, ga_session_id, event_timestamp,
        fixed_traffic_source, fixed_traffic_medium
    from flat
    where ga_session_id is not null
),
rolled as (
    select session_key, user_pseudo_id, ga_session_id,
        event_timestamp as session_start_timestamp,
        first_value(fixed_traffic_source ignore nulls) over path as session_first_source,
        first_value(fixed_traffic_medium ignore nulls) over path as session_first_medium,
        last_value(fixed_traffic_source ignore nulls) over path as session_last_source,
        last_value(fixed_traffic_medium ignore nulls) over path as session_last_medium
    from moments
    window path as (partition by session_key
                    order by event_timestamp asc nulls last, fixed_traffic_source asc nulls last,
                             fixed_traffic_medium asc nulls last
                    rows between unbounded preceding and unbounded following)
)"""

CARRIED = """
carried as (
    select session_key, user_pseudo_id, ga_session_id, session_start_timestamp,
        session_first_source, session_last_source,
        coalesce(last_value(case when session_first_source <> '(direct)' then session_first_source end
                            ignore nulls) over path, '(direct)') as final_session_source,
        coalesce(last_value(case when session_first_medium <> '(none)' then session_first_medium end
                            ignore nulls) over path, '(none)') as final_session_medium
    from (select distinct * exclude (session_last_medium) from rolled)
    window path as (partition by user_pseudo_id
                    order by session_start_timestamp asc nulls last, session_key asc nulls last,
                             ga_session_id asc nulls last
                    rows between unbounded preceding and current row)
)"""


def identity(events: str = "flat") -> str:
    return f"""
identity as (
    select user_pseudo_id, user_id as resolved_user_id
    from (select user_pseudo_id, user_id, min(event_timestamp) as seen
          from {events} where user_id is not null group by all)
    qualify row_number() over (partition by user_pseudo_id order by seen, user_id) = 1
)"""


def single_touch(name: str, direction: str) -> str:
    return f"""
{name} as (
    select user_pseudo_id, session_key, final_session_source, final_session_medium,
        cast(1 as double) as attribution_weight
    from carried
    qualify row_number() over (
        partition by user_pseudo_id
        order by session_start_timestamp {direction} nulls last, session_key {direction} nulls last,
                 ga_session_id {direction} nulls last) = 1
)"""


LAST = single_touch("touched", "desc")
FIRST = single_touch("touched", "asc")

LINEAR = """
touched as (
    select c.user_pseudo_id, session_key, final_session_source, final_session_medium,
        cast(1 as double) / nullif(n, 0) as attribution_weight
    from carried c
    join (select user_pseudo_id, count(session_key) as n from carried group by all) t
      on c.user_pseudo_id is not distinct from t.user_pseudo_id
)"""

SHARES = """
shares as (
    select user_pseudo_id, final_session_source, final_session_medium,
        cast(count(*) as double) / any_value(total) as attribution_weight
    from (select *, count(*) over (partition by user_pseudo_id) as total
          from carried where user_pseudo_id is not null)
    group by user_pseudo_id, final_session_source, final_session_medium
)"""

ORDERS = """
orders_placed as (
    select * from flat where event_name = 'purchase' and transaction_id is not null
)"""

ITEMS = """
items_sold as (
    select o.* exclude (items), i.item_id, i.item_name, i.item_category, i.price, i.quantity,
        coalesce(i.item_revenue, i.price * i.quantity) as item_revenue
    from orders_placed o, unnest(o.items) as u(i)
)"""

_TRANSACTION = """
select p.event_date, p.transaction_id, d.resolved_user_id, p.purchase_revenue, p.tax, p.shipping,
    a.final_session_source as attribution_source, a.final_session_medium as attribution_medium,
    {weight} as attribution_weight, p.purchase_revenue * {weight} as attributed_revenue
from orders_placed p
left join {attribution} a on {on}
left join identity d on d.user_pseudo_id = p.user_pseudo_id"""

_PRODUCT = """
select s.event_date, s.transaction_id, s.item_id, s.item_name, s.item_category, s.price, s.quantity,
    s.item_revenue, a.final_session_source as attribution_source,
    a.final_session_medium as attribution_medium, {weight} as attribution_weight
from items_sold s
left join {attribution} a on {on}"""

# weight of a row that found its own session
_FOUND = "case when a.session_key is not null then cast(1 as double) end"

_FLAT_COLUMNS = """event_id, event_date, event_timestamp, event_name, user_pseudo_id, user_id,
    ga_session_id, session_key, fixed_traffic_source, fixed_traffic_medium, fixed_traffic_campaign,
    transaction_id, purchase_revenue, tax, shipping, len(items) as items"""


def chain(select: str, *steps: str, flat: str = FLAT) -> str:
    return "with" + ",".join([RAW, LOOKED_UP, flat, *steps]) + "\n" + select.strip()


_DATE = "cast(strptime(event_date, '%Y%m%d') as date)"
# every eleventh event without a readable date
UNDATED = FLAT.replace(_DATE, f"case when bundle % 11 <> 0 then {_DATE} end")
# every fifth event of the last days gone
REMOVED = FLAT.replace("from looked_up", "from looked_up where bundle % 5 <> 0 or event_date < '20240128'")
# every fifth event there twice
TWICE = FLAT.replace("from looked_up", "from (from looked_up union all from looked_up where bundle % 5 = 0)")


_PARAMS_JSON = """
coalesce('[' || array_to_string(list_transform(params, lambda p:
    '{"key":' || to_json(p.key)::varchar || ',"value":{"string_value":' || coalesce(to_json(p.s)::varchar, 'null')
    || ',"int_value":' || coalesce(p.i::varchar, 'null') || ',"float_value":null,"double_value":null}}'), ',') || ']', '[]')"""


def key_counts(table: str, rows: str, *key: str) -> str:
    """Rows, missing and repeated keys of a table; where one row stands for all missing keys, they count as one key."""
    missing = " and ".join(f"{column} is null" for column in key)
    again = "n > 1 and not missing" if table == "pre_events" else "n > 1"
    return f"""
select '{table}' as table_name, coalesce(sum(n), 0)::bigint as n_rows,
    coalesce(sum(n) filter (missing), 0)::bigint as without_key, count(*) filter ({again}) as repeated_keys,
    coalesce(sum(n - 1) filter ({again}), 0)::bigint as surplus_rows
from (select {missing} as missing, count(*) as n from {rows} group by {", ".join(key)})"""


_ITEM_COLUMNS = "i.item_id, i.item_name, i.item_category, i.price, i.quantity, i.item_revenue"


# flat events with the FarmHash event id, which no registered query has: it needs Arrow batches
FARM_ID = chain(
    f"""select {_FLAT_COLUMNS} from (
        select flat.* exclude (event_id), user_pseudo_id || event_timestamp || event_name || print as event_id
        from flat left join prints on prints.text = {_PARAMS_JSON})""",
    f"texts as (select {_PARAMS_JSON} as text from flat)",
    farm.prints("texts"),
).replace("with", "with recursive", 1)

_WHOLE_TRANSACTIONS = chain(
    _TRANSACTION.format(attribution="touched", on="a.session_key = p.session_key", weight="a.attribution_weight"),
    ROLLED, CARRIED, LAST, identity(), ORDERS,
)

ORACLE: dict[str, str] = {
    "event_params_lookup": chain(
        """select event_timestamp, event_name, user_pseudo_id, ga_session_id, page_location,
            param_campaign, param_source, param_medium from looked_up"""
    ),
    "traffic_cascade": chain(
        """select event_timestamp, user_pseudo_id, fixed_traffic_source, fixed_traffic_medium,
            fixed_traffic_campaign from flat"""
    ),
    "pre_events": chain(f"select {_FLAT_COLUMNS} from flat"),
    "pre_events_incremental": chain(f"select {_FLAT_COLUMNS} from flat"),
    "pre_events_incremental_by_id": chain(
        # events without an id stay and come again: two loads of the days that were there before
        f"""select {_FLAT_COLUMNS} from flat
        union all
        select {_FLAT_COLUMNS} from flat
        where event_id is null and event_date between date '2024-01-28' and date '2024-01-29'"""
    ),
    "pre_events_single_day": chain(f"select {_FLAT_COLUMNS} from flat where event_date = date '2024-01-24'"),
    "pre_events_fingerprint_id": chain(
        """select event_date, event_name, count(*) as events,
            count(distinct case when user_pseudo_id is not null
                then user_pseudo_id || event_timestamp || event_name || cast(params as varchar) end) as event_ids,
            count(*) filter (where user_pseudo_id is null) as without_id
        from flat group by event_date, event_name"""
    ),
    "event_params_json": chain(
        f"select event_timestamp, event_name, user_pseudo_id, {_PARAMS_JSON} as params_json from raw"
    ),
    "pre_sessions": chain("select * from rolled", ROLLED),
    "pre_sessions_event_grain": chain("select * from rolled", ROLLED_BY_EVENT),
    "pre_sessions_incremental": chain("select * from rolled", ROLLED),
    "sessions": chain("select * from carried", ROLLED, CARRIED),
    "sessions_event_grain": chain("select * from carried", ROLLED_BY_EVENT, CARRIED),
    "sessions_long_paths": chain("select * from carried", ROLLED, CARRIED),
    "unified_id": chain("select * from identity", identity()),
    "unified_id_lookback": chain(
        "select * from identity", identity("(select * from flat where event_date >= date '2024-01-16')")
    ),
    "attribution_first_click": chain("select * from touched", ROLLED, CARRIED, FIRST),
    "attribution_last_non_direct": chain("select * from touched", ROLLED, CARRIED, LAST),
    "attribution_first_click_direct": chain("select * from touched", ROLLED, CARRIED, FIRST),
    "attribution_last_non_direct_direct": chain("select * from touched", ROLLED, CARRIED, LAST),
    "attribution_linear": chain("select * from touched", ROLLED, CARRIED, LINEAR),
    "attribution_linear_event_grain": chain("select * from touched", ROLLED_BY_EVENT, CARRIED, LINEAR),
    "attribution_linear_by_source": chain("select * from shares", ROLLED, CARRIED, SHARES),
    "report_transactions": _WHOLE_TRANSACTIONS,
    "report_products": chain(
        _PRODUCT.format(attribution="touched", on="a.session_key = s.session_key", weight="a.attribution_weight"),
        ROLLED, CARRIED, LAST, ORDERS, ITEMS,
    ),
    "report_transactions_session_scope": chain(
        _TRANSACTION.format(attribution="carried", on="a.session_key = p.session_key", weight=_FOUND),
        ROLLED, CARRIED, identity(), ORDERS,
    ),
    "report_products_session_scope": chain(
        _PRODUCT.format(attribution="carried", on="a.session_key = s.session_key", weight=_FOUND),
        ROLLED, CARRIED, ORDERS, ITEMS,
    ),
    "report_transactions_linear_split": chain(
        _TRANSACTION.format(
            attribution="shares", on="a.user_pseudo_id = p.user_pseudo_id", weight="a.attribution_weight"
        ),
        ROLLED, CARRIED, SHARES, identity(), ORDERS,
    ),
    "raw_day_shards": chain(
        """select event_date, event_name, count(*) as events, count(user_pseudo_id) as with_cookie,
            min(event_timestamp) as first_timestamp, max(event_timestamp) as last_timestamp
        from raw group by event_date, event_name"""
    ),
    "raw_flat_collected": chain(
        """select event_timestamp, collected.source as source, collected.medium as medium,
            collected.name as campaign_name, collected is null as no_record from raw"""
    ),
    "full_refresh": _WHOLE_TRANSACTIONS,
    "daily_refresh": _WHOLE_TRANSACTIONS,
    "daily_refresh_sessions": chain("select * from carried", ROLLED, CARRIED),
    "daily_refresh_pre_events": chain(f"select {_FLAT_COLUMNS} from flat"),
    "daily_refresh_pre_sessions": chain("select * from rolled", ROLLED),
    "daily_refresh_unified_id": chain("select * from identity", identity()),
    "daily_refresh_first_click": chain("select * from touched", ROLLED, CARRIED, FIRST),
    "daily_refresh_last_non_direct": chain("select * from touched", ROLLED, CARRIED, LAST),
    "daily_refresh_linear": chain("select * from touched", ROLLED, CARRIED, LINEAR),
    "daily_refresh_products": chain(
        _PRODUCT.format(attribution="touched", on="a.session_key = s.session_key", weight="a.attribution_weight"),
        ROLLED, CARRIED, LAST, ORDERS, ITEMS,
    ),
    "daily_refresh_after_removal": chain("select * from carried", ROLLED, CARRIED, flat=REMOVED),
    "daily_refresh_after_gap": chain("select * from carried", ROLLED, CARRIED),
    "daily_refresh_transactions_after_removal": chain(
        _TRANSACTION.format(attribution="touched", on="a.session_key = p.session_key", weight="a.attribution_weight"),
        ROLLED, CARRIED, LAST, identity(), ORDERS, flat=REMOVED,
    ),
    "daily_refresh_session_scope": chain(
        _TRANSACTION.format(attribution="carried", on="a.session_key = p.session_key", weight=_FOUND),
        ROLLED, CARRIED, identity(), ORDERS,
    ),
    "daily_refresh_restated_day": chain("select * from carried", ROLLED, CARRIED),
    "audit_violations": chain(
        " union all ".join(
            [
                key_counts("pre_events", "flat", "event_id"),
                key_counts("pre_sessions", "rolled", "user_pseudo_id", "ga_session_id"),
                key_counts("sessions", "carried", "user_pseudo_id", "ga_session_id"),
                key_counts("unified_id", "identity", "user_pseudo_id"),
                key_counts("attribution_first_click", "first_touch", "user_pseudo_id"),
                key_counts("attribution_last_non_direct", "last_touch", "user_pseudo_id"),
            ]
        ),
        ROLLED, CARRIED, identity(), single_touch("first_touch", "asc"), single_touch("last_touch", "desc"), flat=TWICE,
    ),
    "pre_sessions_from_days": chain("select * from rolled", ROLLED),
    "unified_id_from_days": chain("select * from identity", identity()),
    "pre_sessions_incremental_after_removal": chain("select * from rolled", ROLLED, flat=REMOVED),
    "pre_events_incremental_lenient": chain(f"select {_FLAT_COLUMNS} from flat", flat=UNDATED),
    "pre_events_items": chain(
        f"""select event_timestamp, event_name, user_pseudo_id, pos, {_ITEM_COLUMNS}
        from (select *, unnest(range(len(items))) as pos, unnest(items) as i from flat)"""
    ),
    "pre_events_fingerprint_rows": chain(
        f"""select * exclude (event_id), user_pseudo_id || event_timestamp || event_name as id_start
        from (select {_FLAT_COLUMNS} from flat)"""
    ),
    "raw_day_shards_rows": chain(
        """select event_date, event_timestamp, event_name, user_pseudo_id, user_id,
            bundle as event_bundle_sequence_id, server_offset as event_server_timestamp_offset,
            len(params) as params, len(items) as items, transaction_id from raw"""
    ),
    "full_refresh_session_scope": chain(
        _TRANSACTION.format(attribution="carried", on="a.session_key = p.session_key", weight=_FOUND),
        ROLLED, CARRIED, identity(), ORDERS,
    ),
    "report_products_linear_split": chain(
        _PRODUCT.format(
            attribution="shares", on="a.user_pseudo_id = s.user_pseudo_id", weight="a.attribution_weight"
        ),
        ROLLED, CARRIED, SHARES, ORDERS, ITEMS,
    ),
}
