"""The registered queries as SQL for DuckDB, over the same base tables. Written by hand, without the library."""

from __future__ import annotations

import re

LOADED, BATCH, SPLIT = "timestamp '1995-01-06 00:00:00'", "timestamp '1995-03-01 00:00:00'", "timestamp '1998-01-01 00:00:00'"
USERS_UNTIL, EDITED_SINCE = "timestamp '2024-01-04 00:00:00'", "timestamp '2001-07-01 00:00:00'"
NOW, EPOCH, SINCE, BASE = "timestamp '2024-02-01 00:00:00'", "timestamp '1970-01-01 00:00:00'", "date '2001-08-06'", 1706745600000

# In dependency order: a view uses only base tables and views above it.
VIEWS: dict[str, str] = {
    "customers": "select c_custkey as customer_id, c_name as username from customer",
    "sellers": "select s_suppkey as seller_id, s_name as username from supplier",
    "products": """select p_partkey as product_id, p_name as product_name, p_brand as product_description,
        p_type as category, cast(p_retailprice as decimal(18,2)) as price, p_partkey // 20 as seller_id from part""",
    "fact_sales": """select l_orderkey * 1000 + l_linenumber as sale_id, o_custkey as customer_id, l_partkey as product_id,
        l_suppkey as seller_id, cast(l_shipdate as timestamp) as sale_date, cast(l_quantity as int) as quantity,
        cast(l_extendedprice as decimal(18,2)) as total_amount
        from lineitem join orders on l_orderkey = o_orderkey""",
    "star": """select * from fact_sales f where exists (select 1 from products p where p.product_id = f.product_id)
        and exists (select 1 from sellers s where s.seller_id = f.seller_id)
        and exists (select 1 from customers c where c.customer_id = f.customer_id)""",
    "customers_src": """select c_custkey as id, c_name as username, coalesce(created_at, timestamp '1992-01-01 00:00:00')
        as created_at, coalesce(created_at, timestamp '1992-01-01 00:00:00') as updated_at from customer
        left join (select o_custkey, min(cast(o_orderdate as timestamp)) as created_at from orders group by o_custkey)
        on c_custkey = o_custkey""",
    "sellers_src": """select s_suppkey as id, s_name as username, coalesce(created_at, timestamp '1992-01-01 00:00:00')
        as created_at, coalesce(created_at, timestamp '1992-01-01 00:00:00') as updated_at from supplier
        left join (select l_suppkey, min(cast(l_shipdate as timestamp)) as created_at from lineitem group by l_suppkey)
        on s_suppkey = l_suppkey""",
    "products_src": """select p.*, coalesce(created_at, timestamp '1992-01-01 00:00:00') as created_at,
        coalesce(updated_at, timestamp '1992-01-01 00:00:00') as updated_at from products p
        left join (select l_partkey, min(cast(l_shipdate as timestamp)) as created_at,
              max(cast(l_shipdate as timestamp)) as updated_at from lineitem group by l_partkey) on product_id = l_partkey""",
    "products_target": f"select * from products_src where created_at <= {BATCH}",
    "product_edits": f"""select product_id, product_name || ' v2' as product_name, product_description,
        case when p_size > 40 then 'MOVED' else category end as category,
        cast(price * cast(1.10 as decimal(3,2)) as decimal(18,2)) as price, seller_id, created_at, updated_at
        from products_src join part on p_partkey = product_id where updated_at >= {EDITED_SINCE}""",
    "ev": """select event_id, user_id, event_type, value, cast(ts as timestamp) as ts,
        cast(json_extract_string(props, '$.k') as bigint) as k from events""",
    "evs": """select *, 'tok' || user_id || '-' || k as session_token, user_id * 20 + k as product_id,
        'user' || user_id as login, case when user_id % 2 = 0 then 'customer' else 'seller' end as role from ev""",
    "users": f"""select distinct user_id, login as user_login, role as user_role from evs
        where event_type = 'signup' and ts <= {USERS_UNTIL}""",
    "sessions": """select session_token, min(user_id) as user_id,
        min(case when event_type = 'signup' then ts end) as session_start,
        max(case when event_type = 'error' then ts end) as session_end
        from evs where event_type in ('signup', 'error') group by session_token
        having min(case when event_type = 'signup' then ts end) is not null""",
    "registrations": """select event_id as request_id, login as username,
        case when value >= 100 then 'admin' else role end as user_role, ts as created_at
        from evs where event_type = 'signup'""",
    "ranked": """select r.*, row_number() over (partition by username order by created_at, request_id) as place
        from registrations r where user_role in ('seller', 'customer')
        and username not in (select user_login from users)""",
    "outcomes": """select r.*, case when k.place = 1 then 'registered' when r.user_role in ('seller', 'customer')
        then 'duplicate' else 'bad_role' end as outcome
        from registrations r left join ranked k on k.request_id = r.request_id""",
    "requests": """select event_id as request_id, session_token,
        case when event_type = 'purchase' then 'customer' else 'seller' end as needed_role from evs""",
    "edit_requests": """select event_id as request_id, session_token, product_id, 'edit ' || event_id as product_name,
        case when value >= 10 then cast(value as decimal(18,2)) end as price, 'seller' as needed_role
        from evs where event_type = 'click'""",
    "checked_edits": """select r.request_id, s.user_id, r.product_id, r.product_name, r.price,
        p.product_name as old_product_name, p.price as old_price, p.product_description as old_product_description,
        p.seller_id as old_seller_id, p.created_at as old_created_at, p.category as old_category,
        cast(case when s.user_id is null then 401 when u.user_role is null then 404 when u.user_role <> r.needed_role then 403
             when p.seller_id is null then 404 when p.seller_id <> s.user_id then 403 else 200 end as int) as status
        from edit_requests r left join sessions s on s.session_token = r.session_token
        left join users u on u.user_id = s.user_id left join products_src p on p.product_id = r.product_id""",
    "added": f"""select {BASE} * 1000 + row_number() over (order by event_id) - 1 as product_id,
        'new ' || event_id as product_name, '' as product_description, 'CATEGORY ' || (k % 5) as category,
        cast(value as decimal(18,2)) as price, s.user_id as seller_id, {NOW} as created_at, {NOW} as updated_at
        from evs e join sessions s on s.session_token = e.session_token join users u on u.user_id = s.user_id
        where event_type = 'view' and user_role = 'seller'""",
    "purchases": """select event_id as sell_id, user_id as customer_id, product_id,
        cast(1 + event_id % 5 as int) as quantity, ts from evs where event_type = 'purchase'""",
    "enriched": """select sell_id, customer_id, product_id, seller_id, price, quantity, ts
        from purchases join products using (product_id)""",
    "purchase_checks": """select e.event_id as request_id, s.user_id, e.product_id, cast(1 + e.event_id % 5 as int) as quantity,
        p.price, p.seller_id, e.ts, cast(case when s.user_id is null then 401 when u.user_role is null then 404
        when u.user_role <> 'customer' then 403 when p.product_id is null then 400 else 200 end as int) as status
        from evs e left join sessions s on s.session_token = e.session_token left join users u on u.user_id = s.user_id
        left join products p on p.product_id = e.product_id where e.event_type = 'purchase'""",
    "gated": f"""select {BASE} * 1000 + row_number() over (order by request_id) - 1 as sell_id, user_id as customer_id, product_id,
        seller_id, price, quantity, ts from purchase_checks where status = 200""",
    "live_sales": f"""select sell_id as sale_id, customer_id, product_id, seller_id, date_trunc('second', ts) as sale_date,
        quantity, cast(price * quantity as decimal(18,2)) as total_amount, {NOW} as batch_time from gated""",
    "live_star": """select * from live_sales f where exists (select 1 from products p where p.product_id = f.product_id)
        and exists (select 1 from sellers s where s.seller_id = f.seller_id)
        and exists (select 1 from customers c where c.customer_id = f.customer_id)""",
    "strays": """select case when event_type = 'error' then 'error ' || event_id
        else '{"sell_id":' || event_id || ',"customer_id":' || user_id || ',"note":"' || event_type || '"}' end as value,
        ts as "timestamp", case when event_type = 'error' then 'malformed' else 'missing_fields' end as reason,
        case when event_type <> 'error' then 'product_id,seller_id,quantity' end as missing_fields
        from evs where event_type <> 'purchase'""",
}

UNITS = "cast(sum(quantity) as bigint)"
MONEY = "cast(sum(total_amount) as decimal(28,2))"
KINDS = {"product": "product_id", "seller": "seller_id", "customer": "customer_id"}
DAY, MONTH = "cast(sale_date as date)", "cast(date_trunc('month', sale_date) as date)"


def _with(body: str) -> str:
    """Put the views that the text needs, directly or through another view, in front of it."""
    needed: list[str] = []
    text = body
    for name in reversed(VIEWS):
        if re.search(rf"\b{name}\b", text):
            needed.insert(0, name)
            text += " " + VIEWS[name]
    if not needed:
        return body
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in needed) + "\n" + body


def _series(period: str, kind: str) -> str:
    bucket, column = (DAY, "sale_date") if period == "daily" else (MONTH, "sale_month")
    return (f"select {bucket} as {column}, {KINDS[kind]}, {UNITS} as total_quantity, {MONEY} as total_amount "
            f"from star group by {bucket}, {KINDS[kind]}")


FLAT = {
    "units_by_product": f"select product_id, {UNITS} as total_quantity_sold from fact_sales group by product_id",
    "spend_by_customer": f"select customer_id, {MONEY} as total_amount_spent from fact_sales group by customer_id",
    "revenue_by_seller": f"select seller_id, {MONEY} as total_revenue from fact_sales group by seller_id",
    "units_by_seller": f"select seller_id, {UNITS} as total_quantity_sold from fact_sales group by seller_id",
}
AVERAGE = "case when total_sales_count > 0 then cast(total_revenue / total_sales_count as decimal(28,6)) end"
TOTALS = (f"select coalesce({MONEY}, 0) as total_revenue, count(sale_id) as total_sales_count from fact_sales")


def _all_rollups(fact: str, star: str) -> str:
    """Every rollup as state rows: name, period, key, and all three measures."""
    measures = f"{UNITS} as total_quantity, {MONEY} as total_amount, count(sale_id) as sales_count"
    parts = []
    for kind, key in KINDS.items():
        for period, bucket in (("daily", DAY), ("monthly", MONTH)):
            parts.append(f"select '{period}_sales_by_{kind}' as rollup, {bucket} as period, {key} as key_id, {measures} "
                         f"from {star} group by {bucket}, {key}")
    for name, key in (("units_by_product", "product_id"), ("spend_by_customer", "customer_id"),
                      ("revenue_by_seller", "seller_id"), ("units_by_seller", "seller_id")):
        parts.append(f"select '{name}' as rollup, cast(null as date) as period, {key} as key_id, {measures} "
                     f"from {fact} group by {key}")
    parts.append(f"select 'average_sale_check' as rollup, cast(null as date) as period, cast(null as bigint) as key_id, "
                 f"{measures} from {fact}")
    return "\nunion all ".join(parts)


def _panel(period: str, kind: str, columns: str, since: bool = False) -> str:
    column = "sale_date" if period == "daily" else "sale_month"
    table, label = {"product": ("products", "product_name"), "seller": ("sellers", "username"),
                    "customer": ("customers", "username")}[kind]
    cut = f" where r.{column} >= {SINCE}" if since else ""
    return (f"select r.{column}, d.{label}, {columns} from ({_series(period, kind)}) r "
            f"join {table} d on d.{KINDS[kind]} = r.{KINDS[kind]}{cut} order by r.{column}, d.{label}, r.{KINDS[kind]}")


def _top(rollup: str, key: str, table: str, label: str, measure: str) -> str:
    return (f"select d.{label}, r.{measure} from ({FLAT[rollup]}) r join {table} d on d.{key} = r.{key} "
            f"order by r.{measure} desc, r.{key} limit 10")


def _loaded(table: str) -> str:
    return f"select *, {LOADED} as batch_time from {table}_src where created_at > {EPOCH} and created_at <= {LOADED}"


def _new(table: str) -> str:
    columns = {"customers": "id as customer_id, username, created_at, updated_at",
               "sellers": "id as seller_id, username, created_at, updated_at",
               "products": "product_id, product_name, product_description, category, price, seller_id, created_at, updated_at"}
    low = f"(select coalesce(max(batch_time), {EPOCH}) from ({_loaded(table)}))"
    return (f"select {columns[table]}, {BATCH} as batch_time from {table}_src "
            f"where created_at > {low} and created_at <= {BATCH}")


def _daily_run() -> str:
    parts = []
    for table, key, name in (("customers", "id", "username"), ("sellers", "id", "username"),
                             ("products", "product_id", "product_name")):
        parts.append(f"select '{table}' as table_name, {key} as id, {name} as name, created_at, "
                     f"case when created_at <= {LOADED} then {LOADED} else {BATCH} end as batch_time "
                     f"from {table}_src where created_at > {EPOCH} and created_at <= {BATCH}")
    return " union all ".join(parts)


_CATALOGUE = "product_id, product_name, product_description, price, seller_id, created_at, updated_at, category"
_ISO = "'%Y-%m-%dT%H:%M:%S.000Z'"
_DOCUMENT = f"""'{{"product_id":' || product_id || ',"product_name":' || to_json(product_name)
    || ',"product_description":' || to_json(product_description)
    || ',"price":' || price || ',"seller_id":' || seller_id || ',"created_at":"' || strftime(created_at, {_ISO})
    || '","updated_at":"' || strftime(updated_at, {_ISO}) || '","category":' || to_json(category) || '}}'"""
_MESSAGE = """'{"customer_id":' || customer_id || ',"product_id":' || product_id || ',"sell_id":' || sell_id
    || ',"price":' || price || ',"seller_id":' || seller_id || ',"quantity":' || quantity || '}'"""

_EDITED = f"""select product_id, coalesce(arg_max(product_name, request_id), any_value(old_product_name)) as product_name,
    any_value(old_product_description) as product_description,
    coalesce(arg_max(price, request_id) filter (price is not null), any_value(old_price)) as price,
    any_value(old_seller_id) as seller_id, any_value(old_created_at) as created_at, {NOW} as updated_at,
    any_value(old_category) as category from checked_edits where status = 200 group by product_id"""


def _access(sessions: str, role: str) -> str:
    return (f"select r.request_id, s.user_id{role}, cast(case when s.user_id is null then 401 when u.user_role is null then 404 "
            "when u.user_role <> r.needed_role then 403 else 200 end as int) as status from requests r "
            f"left join {sessions} s on s.session_token = r.session_token left join users u on u.user_id = s.user_id")


def _constraints() -> str:
    def unique(table: str, key: str) -> str:
        return f"select '{table}.{key} unique', count({key}) - count(distinct {key}) from {table}"

    def filled(table: str, column: str) -> str:
        return f"select '{table}.{column} not null', count(*) - count({column}) from {table}"

    rows = [unique("users", "user_login"), filled("users", "user_id"), filled("users", "user_login"),
            filled("users", "user_role"),
            "select 'users.user_login length <= 255', count(case when length(user_login) > 255 then 1 end) from users",
            unique("sessions", "session_token"), filled("sessions", "user_id"), filled("sessions", "session_start"),
            "select 'sessions.user_id references users', count(*) from sessions "
            "where user_id is not null and user_id not in (select user_id from users)",
            unique("registrations", "username")]
    for table, key in (("customers", "customer_id"), ("sellers", "seller_id")):
        rows += [unique(table, key), unique(table, "username"), filled(table, key), filled(table, "username"),
                 f"select '{table}.username length <= 50', count(case when length(username) > 50 then 1 end) from {table}"]
    body = " union all ".join(rows)
    return f"select constraint_name, cast(violations as bigint) as violations from ({body}) t(constraint_name, violations)"


def oracle_sql() -> dict[str, str]:
    both = "r.total_quantity, r.total_amount"
    sql = {"star_existence": "select * from star"}
    for period in ("daily", "monthly"):
        for kind in KINDS:
            sql[f"{period}_sales_by_{kind}"] = _series(period, kind)
            sql[f"dash_{period}_sales_by_{kind}"] = _panel(period, kind, both)
            sql[f"dash_{period}_sales_by_{kind}_since"] = _panel(period, kind, both, since=True)
            sql[f"{period}_sales_by_{kind}_since"] = _panel(period, kind, both, since=True)
    sql |= FLAT
    sql |= {
        "average_sale_check": TOTALS,
        "backfill_rollups": _all_rollups("fact_sales", "star"),
        "compact_rollup": _all_rollups("fact_sales", "star"),
        "dash_daily_product_amount": _panel("daily", "product", "r.total_amount"),
        "dash_top_products_by_quantity": _top("units_by_product", "product_id", "products", "product_name", "total_quantity_sold"),
        "dash_top_customers_by_amount": _top("spend_by_customer", "customer_id", "customers", "username", "total_amount_spent"),
        "dash_top_sellers_by_revenue": _top("revenue_by_seller", "seller_id", "sellers", "username", "total_revenue"),
        "dash_top_sellers_by_quantity": _top("units_by_seller", "seller_id", "sellers", "username", "total_quantity_sold"),
        "dash_average_check": f"select {AVERAGE} as average_check from ({TOTALS})",
        "daily_run": _daily_run(),
        "compact_dimension": "select id as seller_id, username, created_at, updated_at, "
                             f"case when created_at <= {LOADED} then {LOADED} else {BATCH} end as batch_time "
                             f"from sellers_src where created_at > {EPOCH} and created_at <= {BATCH}",
        "merge_rollup_increment": _series("monthly", "seller"),
        "merge_average_check": TOTALS,
        "append_product": f"select {_CATALOGUE} from products_src union all select {_CATALOGUE} from added",
        "upsert_products": """select coalesce(e.product_id, t.product_id) as product_id,
            coalesce(e.product_name, t.product_name) as product_name,
            coalesce(e.product_description, t.product_description) as product_description,
            coalesce(e.price, t.price) as price, coalesce(e.seller_id, t.seller_id) as seller_id,
            coalesce(t.created_at, e.created_at) as created_at, coalesce(e.updated_at, t.updated_at) as updated_at,
            coalesce(e.category, t.category) as category
            from products_target t full outer join product_edits e on e.product_id = t.product_id""",
        "upsert_update_records": f"""select {_CATALOGUE} from products_target union all select {_CATALOGUE} from products_src
            join part on p_partkey = product_id where p_size >= 10
            and product_id not in (select product_id from products_target)""",
        "list_products": f"select product_id, {_DOCUMENT} as document from products_src",
        "validate_product_updates": """select s.product_id as record_id, product_name, price,
            case when p_size < 10 then 'product_description' else '' end as missing_fields
            from products_src s join part on p_partkey = s.product_id""",
        "authorised_product_edits": """select request_id, user_id, product_id, product_name, price, old_product_name,
            old_price, status from checked_edits""",
        "edited_products": _EDITED,
        "edit_products": f"""select {_CATALOGUE} from products_src
            where product_id not in (select product_id from checked_edits where status = 200)
            union all select {_CATALOGUE} from ({_EDITED})""",
        "authorise_requests": _access("sessions", ", u.user_role"),
        "authorise_active_requests": _access("(select * from sessions where session_end is null)", ""),
        "register_users": "select request_id, username, user_role, created_at, outcome from outcomes",
        "new_users": """select (select max(user_id) from users) + row_number() over (order by created_at, request_id) as user_id,
            username as user_login, user_role from outcomes where outcome = 'registered'""",
        "new_accounts": """select case when user_role = 'customer' then 'customers' else 'sellers' end as table_name, username,
            created_at, created_at as updated_at from outcomes o where outcome = 'registered'
            and not exists (select 1 from customers c where o.user_role = 'customer' and c.username = o.username)
            and not exists (select 1 from sellers s where o.user_role = 'seller' and s.username = o.username)""",
        "registered_tables": " union all ".join(
            f"""select '{table}' as table_name, id, username, created_at from {table}_src union all
            select '{table}', (select max(id) from {table}_src) + row_number() over (order by created_at, username), username, created_at
            from outcomes o where outcome = 'registered' and user_role = '{role}'
            and not exists (select 1 from {table}_src c where c.username = o.username)"""
            for table, role in (("customers", "customer"), ("sellers", "seller"))) + """
            union all select 'users', user_id, user_login, cast(null as timestamp) from users
            union all select 'users', (select max(user_id) from users) + row_number() over (order by created_at, request_id), username,
            cast(null as timestamp) from outcomes where outcome = 'registered'""",
        "quarantined_rows": """select 'registrations' as table_name, r.request_id as id, case when user_role = 'admin'
            then 'user_role in seller, customer' when r.request_id <> f.first_id then 'username unique' else '' end as broken
            from registrations r left join (select username, arg_min(request_id, (created_at, request_id)) as first_id from registrations
            where user_role <> 'admin' group by username) f on f.username = r.username
            union all select 'purchases', sell_id, concat_ws('; ', case when quantity >= 5 then 'quantity below 5' end,
            case when customer_id not in (select customer_id from customers) then 'customer_id references' end,
            case when product_id not in (select product_id from products) then 'product_id references' end) from purchases""",
        "stream_sessions": "select * from sessions",
        "check_constraints": _constraints(),
        "sessionise_logins": "select * from sessions",
        "enrich_purchases": "select sell_id, customer_id, product_id, seller_id, price, quantity, ts from enriched",
        "refused_purchases": """select sell_id, customer_id, product_id, quantity from purchases
            where product_id not in (select product_id from products)""",
        "publish_purchases": f"""select cast(sell_id as varchar) as key, {_MESSAGE} as value, ts as "timestamp" from gated""",
        "reject_purchases": "select * from strays",
        "stream_rejects": "select * from strays",
        "stream_purchases": "select * from live_sales",
        "stream_repeated_purchases": "select * from live_sales",
        "stream_gated_purchases": """select request_id, user_id, product_id, quantity, price, seller_id, status,
            case when status = 200 then user_id end as sent_customer_id, case when status = 200 then product_id end as sent_product_id,
            case when status = 200 then cast(quantity as bigint) end as sent_quantity, case when status = 200 then true end as own_id
            from purchase_checks""",
        "stream_rollups": _all_rollups("live_sales", "live_star"),
        "purchase_outcomes": "select request_id, user_id, product_id, quantity, price, seller_id, status from purchase_checks",
        "conform_fact": f"""select sale_id, customer_id, product_id, seller_id, sale_date, quantity,
            cast(0 as decimal(18,2)) as total_amount, {EPOCH} as batch_time from fact_sales""",
        "price_sales": """select sale_id, product_id, quantity, coalesce(price, 50.00) as price,
            cast(coalesce(price, 50.00) * quantity as decimal(18,2)) as total_amount
            from fact_sales left join products_target using (product_id)""",
        "assign_ids": f"""select sell_id, customer_id, {BASE} * 1000 + row_number() over (order by sell_id) - 1 as assigned_id
            from purchases""",
    }
    for table in ("customers", "sellers", "products"):
        sql[f"high_watermark_{table}"] = (
            f"select coalesce(max(batch_time), {EPOCH}) as high_watermark from (select batch_time from ({_loaded(table)}) union all "
            f"select {BATCH} from {table}_src where created_at > {LOADED} and created_at <= {BATCH})")
        sql[f"sync_new_{table}"] = _new(table)
    sql["resumed_upsert"] = sql["upsert_products"]
    return {name: _with(text) for name, text in sql.items()}

