"""The registered queries once more, as SQL over the given tables.

The feed (``marmita/sources/feed.py``) is restated here on the rows themselves,
without documents or parsing, so both sides share no step.
"""

from __future__ import annotations

import re

from marmita.rules import RULES

_PAY = "(['PIX', 'CARTÃO CREDITO', 'CARTÃO DEBITO', 'VOUCHER', 'CHEQUE'])"
_CATEGORY = "(['Hamburguer', 'Pizza', 'Comida Japonesa', 'Sobremesa', 'Bebida', 'Outros'])"
_VEHICLE = "(['moto', 'carro', 'bicicleta', 'patinete'])"


def _clock(seconds: str) -> str:
    return f"make_timestamp(CAST((1704067200 + ({seconds}) % 31536000) * 1000000 AS BIGINT))"


def _batch(seq: str) -> str:
    return f"lpad(CAST({seq} AS VARCHAR), 20, '0')"


def _rule(predicate: str) -> str:
    """A Spark predicate in DuckDB spelling, null counting as failed."""
    spelled = re.sub(r"(\w+) RLIKE ('[^']*')", r"regexp_matches(\1, \2)", predicate)
    return f"coalesce({spelled}, false)"


def _all_rules(table: str) -> str:
    return " AND ".join(_rule(p) for p in RULES[table].values())


def _avg(value: str) -> str:
    """Average of a decimal(10,2), rounded to 6 and then to 2 places, in whole numbers."""
    total, n = f"sum(CAST({value} * 100 AS BIGINT))", f"count({value})"
    return (f"CAST(((((({total}) * 20000 + {n}) // (2 * {n})) + 5000) // 10000) / 100.0 "
            "AS DECIMAL(18,2))")


_FIRST = {
    "clientes": ("cl", "client_id", "client_id, nome, endereco, cpf, tipo_pagamento, created_at"),
    "restaurantes": ("re", "merchant_id", "merchant_id, nome, endereco, cnpj, created_at"),
    "drivers": ("dr", "driver_id", "driver_id, nome, endereco, veiculo, placa, created_at"),
    "items": ("it", "item_id", "item_id, nome, categoria, preco, merchant_id, created_at"),
}

_CTES: dict[str, str] = {
    # one row per event
    "ev": f"""
        SELECT seq, kind, k, {_batch('seq')} AS batch_id,
               kind = 2 AND k % 50 = 8 AS missing, kind = 2 AND k % 50 = 7 AS unparsable
        FROM (SELECT c_custkey * 8 AS seq, c_custkey AS k, 0 AS kind FROM customer UNION ALL
              SELECT s_suppkey * 8 + 1, s_suppkey, 1 FROM supplier UNION ALL
              SELECT event_id * 8 + 2, event_id, 2 FROM events UNION ALL
              SELECT p_partkey * 8 + 3, p_partkey, 3 FROM part UNION ALL SELECT seq, o_orderkey, 4 FROM os)""",
    # every (order, part) pair, and the chunks of about eight parts that order events hold
    "lp": """
        SELECT l_orderkey, l_partkey, min(l_suppkey) AS suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS v
        FROM lineitem GROUP BY l_orderkey, l_partkey""",
    "li": """
        SELECT l_orderkey, l_partkey % CAST(ceil(n / 8.0) AS BIGINT) AS chunk, min(suppkey) AS suppkey,
               CAST(sum(q) AS BIGINT) AS quantity, list({'item': l_partkey, 'q': q, 'v': v}) AS lines
        FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lp) GROUP BY 1, 2""",
    "os": f"""
        SELECT *, {_batch('seq')} AS batch_id,
               CASE WHEN o_orderkey % 101 <> 0 THEN o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
                    + to_hours(CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 0 END) END AS created
        FROM (SELECT orders.*, li.*, (o_orderkey + coalesce(chunk, 0) * 68719476736) * 8 + 4 AS seq
              FROM orders LEFT JOIN li ON o_orderkey = l_orderkey)""",
    "cl": f"""
        SELECT c_custkey * 8 AS seq, 0 AS pos, {_batch('c_custkey * 8')} AS batch_id,
               'C' || c_custkey AS client_id, c_name AS nome, n_name AS endereco,
               left(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), CASE WHEN c_custkey % 17 = 0 THEN 10 ELSE 11 END) AS cpf,
               {_PAY}[CAST(c_custkey % 5 AS INTEGER) + 1] AS tipo_pagamento, {_clock('c_custkey')} AS created_at
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT seq, 0, batch_id, 'C' || o_custkey, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0'), o_orderpriority,
               left(lpad(CAST(o_custkey AS VARCHAR), 11, '0'), CASE WHEN o_orderkey % 17 = 0 THEN 10 ELSE 11 END),
               {_PAY}[CAST(o_custkey % 5 AS INTEGER) + 1], created
        FROM os""",
    "re": f"""
        SELECT s_suppkey * 8 + 1 AS seq, pos, {_batch('s_suppkey * 8 + 1')} AS batch_id, 'R' || s_suppkey AS merchant_id,
               CASE WHEN pos = 1 THEN 'Filial ' || s_name WHEN s_suppkey % 13 <> 0 THEN s_name END AS nome,
               n_name AS endereco,
               left(lpad(CAST(s_suppkey AS VARCHAR), 14, '0'), CASE WHEN s_suppkey % 19 = 0 THEN 13 ELSE 14 END) AS cnpj,
               {_clock('s_suppkey * 3600')} AS created_at
        FROM (SELECT *, unnest(CASE WHEN s_suppkey % 7 = 0 THEN [0, 1] ELSE [0] END) AS pos FROM supplier)
        LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "dr": f"""
        SELECT event_id * 8 + 2 AS seq, 0 AS pos, {_batch('event_id * 8 + 2')} AS batch_id, 'D' || user_id AS driver_id,
               'Driver ' || user_id AS nome, event_type AS endereco,
               {_VEHICLE}[CAST(event_id % 4 AS INTEGER) + 1] AS veiculo,
               CASE WHEN event_id % 11 = 0 THEN 'abc-' ELSE 'ABC-' END
                 || lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0') AS placa,
               ts AS created_at
        FROM events WHERE event_id % 50 NOT IN (7, 8)""",
    "it": f"""
        SELECT p_partkey * 8 + 3 AS seq, pos, {_batch('p_partkey * 8 + 3')} AS batch_id, 'I' || p_partkey AS item_id,
               p_name AS nome, {_CATEGORY}[CAST(p_partkey % 6 AS INTEGER) + 1] AS categoria,
               CASE WHEN p_partkey % 97 <> 0 THEN
                 TRY_CAST((CAST(round(p_retailprice * 100) AS BIGINT) + pos * 100) / 100.0 AS DECIMAL(10,2)) END AS preco,
               'R' || (p_partkey % (SELECT count(*) FROM supplier)) AS merchant_id, {_clock('p_partkey * 60')} AS created_at
        FROM (SELECT *, unnest(CASE WHEN p_partkey % 5 = 0 THEN [0, 1] ELSE [0] END) AS pos FROM part)""",
    # orders before their rules; 'amount' is the unrounded value
    "ord": f"""
        SELECT batch_id, 'P' || o_orderkey AS order_id, 'C' || o_custkey AS client_id, 'R' || suppkey AS merchant_id,
               'R' || suppkey AS restaurant_id, 'D' || (o_orderkey % (SELECT max(user_id) + 1 FROM events)) AS driver_id,
               TRY_CAST(trunc(quantity + CASE WHEN o_orderkey % 113 = 0 THEN 0.9 ELSE 0 END) AS INTEGER) AS quantidade_total,
               amount, TRY_CAST(amount AS DECIMAL(10,2)) AS valor_total,
               {_PAY}[CAST(o_custkey % 5 AS INTEGER) + 1] AS tipo_pagamento, created AS created_at,
               CAST(created AS DATE) AS order_date, CAST(year(created) AS INTEGER) AS order_year,
               CAST(month(created) AS INTEGER) AS order_month, CAST(day(created) AS INTEGER) AS order_day,
               CAST(hour(created) AS INTEGER) AS order_hour,
               CASE WHEN amount >= 200 THEN 'High' WHEN amount >= 100 THEN 'Medium' ELSE 'Low' END AS amount_category,
               coalesce(lines, []) AS products, seq
        FROM (SELECT *, unnest(CASE WHEN o_orderkey % 211 = 0 THEN [0, 1] ELSE [0] END) AS copy,
                     CASE WHEN o_orderkey % 103 = 0 THEN CAST(199.999 AS DOUBLE) WHEN o_orderkey % 107 = 0 THEN -1
                          WHEN o_orderkey % 109 = 0 THEN 1000000000
                          ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 1000 AS DOUBLE) / 100 END AS amount
              FROM os)""",
    "no_orders": "SELECT count(*) AS n FROM ev WHERE kind <> 4",
    "ord_outer": """
        SELECT batch_id, order_id, client_id, merchant_id, restaurant_id, driver_id, quantidade_total, amount,
               valor_total, tipo_pagamento, created_at, order_date, order_year, order_month, order_day, order_hour,
               amount_category FROM ord
        UNION ALL
        SELECT CASE WHEN NOT missing AND NOT unparsable THEN batch_id END, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
               NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'Low' FROM ev WHERE kind <> 4""",
    "s_orders": f"SELECT * FROM ord WHERE {_all_rules('silver_orders')}",
    "oi": f"""
        SELECT batch_id, order_id, 'I' || p.item AS item_id, 'Item ' || p.item AS nome,
               {_CATEGORY}[CAST(p.item % 6 AS INTEGER) + 1] AS categoria,
               TRY_CAST(CAST(p.v // nullif(p.q, 0) AS DOUBLE) / 100 AS DECIMAL(10,2)) AS preco,
               TRY_CAST(p.q AS INTEGER) AS quantidade,
               TRY_CAST(CAST(p.v AS DOUBLE) / 100 AS DECIMAL(10,2)) AS valor_total_item, created_at
        FROM (SELECT batch_id, order_id, created_at, unnest(products) AS p FROM s_orders)""",
    "s_order_items": f"SELECT * FROM oi WHERE {_all_rules('silver_order_items')}",
}
for _name, (_rows, _key, _columns) in _FIRST.items():
    _table = f"silver_{_name}"
    _CTES[f"first_{_name}"] = f"""
        SELECT batch_id, {_columns} FROM (
          SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY seq % 31536000, seq, pos) AS rn FROM {_rows}) WHERE rn = 1"""
    # events without this entity collapse into one null key, claimed by the earliest of them
    _kind = {"clientes": "(0, 4)", "restaurantes": "(1)", "drivers": "(2)", "items": "(3)"}[_name]
    _nulls = ", ".join("NULL" for _ in _columns.split(","))
    _CTES[f"null_{_name}"] = f"""
        SELECT CASE WHEN NOT missing AND NOT unparsable THEN batch_id END AS batch_id, seq FROM ev
        WHERE kind NOT IN {_kind} OR missing OR unparsable"""
    _CTES[f"claimed_{_name}"] = f"""
        SELECT * FROM first_{_name} UNION ALL
        SELECT batch_id, {_nulls} FROM (SELECT batch_id FROM null_{_name} ORDER BY seq % 31536000, seq LIMIT 1)"""
    _CTES[f"outer_{_name}"] = f"""
        SELECT batch_id, {_columns} FROM {_rows} UNION ALL SELECT batch_id, {_nulls} FROM null_{_name}"""
    _CTES[f"s_{_name}"] = f"SELECT * FROM first_{_name} WHERE {_all_rules(_table)}"
    _CTES[f"vf_{_name}"] = f"""
        SELECT batch_id, {_columns} FROM (
          SELECT *, row_number() OVER (PARTITION BY {_key} ORDER BY seq % 31536000, seq, pos) AS rn FROM {_rows}
          WHERE {_all_rules(_table)}) WHERE rn = 1"""

_COST_KEYS = ("usage_date, resource_id, resource_type, resource_group, service_name, meter_category, "
              "meter_subcategory, currency")
_CTES |= {
    "usage": """
        SELECT CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS usage_date,
               CASE WHEN l_orderkey % 97 = 0 THEN '0' WHEN l_orderkey % 89 = 0 THEN 'n/a'
                    WHEN m = 'base' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,6)) AS VARCHAR)
                    ELSE CAST(CAST(CAST(round(l_extendedprice * l_tax * 100) AS BIGINT) / 100.0 AS DECIMAL(18,6)) AS VARCHAR)
               END AS pretax_cost,
               'res-' || l_partkey AS resource_id, 'type-' || (l_partkey % 6) AS resource_type,
               'rg-' || (l_suppkey % 20) AS resource_group, 'svc-' || (l_suppkey % 5) AS service_name,
               l_returnflag AS meter_category, l_linestatus || '-' || m AS meter_subcategory, 'BRL' AS currency
        FROM (SELECT *, unnest(['base', 'tax']) AS m FROM lineitem)""",
    "charges": """
        SELECT TRY_CAST(usage_date AS DATE) AS usage_date, TRY_CAST(pretax_cost AS DECIMAL(18,6)) AS pretax_cost,
               resource_id, resource_type, resource_group, service_name, meter_category, meter_subcategory, currency,
               'subscription-1' AS subscription_id
        FROM usage""",
    "summary": """
        SELECT usage_date, resource_group, service_name, currency,
               CAST(sum(pretax_cost) AS DECIMAL(18,6)) AS total_cost, count(DISTINCT resource_id) AS resource_count
        FROM charges GROUP BY usage_date, resource_group, service_name, currency""",
}


def sql(body: str) -> str:
    """``body`` with the common table expressions it names, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(_CTES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n].strip()})" for n in needed) + "\n" + body


_RAW = f"""
    SELECT seq AS sequence_number, CAST(seq * 100 AS VARCHAR) AS eventhub_offset, {_clock('seq')} AS enqueued_time_utc,
           CAST(seq % 2 AS VARCHAR) AS bus_partition, 'delivery_fake_batch' AS event_type,
           batch_id AS property_batch_id, missing AS body_missing FROM ev"""
_HEADER = "CASE WHEN NOT missing AND NOT unparsable THEN {} END"

_ORDER_COLUMNS = ("batch_id, order_id, client_id, merchant_id, restaurant_id, driver_id, quantidade_total, valor_total, "
                  "tipo_pagamento, created_at, order_date, order_year, order_month, order_day, order_hour, amount_category")
_KPIS = f"""
    SELECT CAST(created_at AS DATE) AS metric_date, tipo_pagamento, count(DISTINCT order_id) AS total_orders,
           count(DISTINCT client_id) AS unique_clients, count(DISTINCT merchant_id) AS unique_restaurants,
           count(DISTINCT driver_id) AS unique_drivers, CAST(sum(quantidade_total) AS BIGINT) AS total_items,
           CAST(sum(valor_total) AS DECIMAL(18,2)) AS total_revenue, {_avg('valor_total')} AS avg_order_value
    FROM s_orders GROUP BY CAST(created_at AS DATE), tipo_pagamento"""
_RESTAURANTS = f"""
    SELECT CAST(o.created_at AS DATE) AS order_date, o.merchant_id AS restaurant_id, r.nome AS restaurant_name,
           count(DISTINCT o.order_id) AS total_orders, count(DISTINCT o.client_id) AS unique_clients,
           CAST(sum(o.valor_total) AS DECIMAL(18,2)) AS total_revenue, {_avg('o.valor_total')} AS avg_order_value
    FROM s_orders o LEFT JOIN s_restaurantes r ON o.merchant_id = r.merchant_id
    GROUP BY CAST(o.created_at AS DATE), o.merchant_id, r.nome"""
_CATEGORIES = f"""
    SELECT categoria, count(DISTINCT order_id) AS orders_with_category, count(DISTINCT item_id) AS unique_items,
           CAST(sum(quantidade) AS BIGINT) AS total_quantity,
           CAST(sum(valor_total_item) AS DECIMAL(18,2)) AS total_revenue, {_avg('preco')} AS avg_item_price
    FROM s_order_items GROUP BY categoria"""


def _metrics(rows: str, table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {_rule(p)}) AS passed, "
        f"count(*) FILTER (WHERE NOT {_rule(p)}) AS failed FROM {rows}"
        for name, p in RULES[table].items())


def _broken(table: str) -> str:
    names = ", ".join(f"CASE WHEN NOT {_rule(p)} THEN '{name}' END" for name, p in RULES[table].items())
    return f"concat_ws(',', {names})"


def _broken_count(table: str) -> str:
    return " + ".join(f"CAST(NOT {_rule(p)} AS INTEGER)" for p in RULES[table].values())


def _total(columns: str) -> str:
    return f"SELECT {columns}, CAST(sum(pretax_cost) AS DECIMAL(18,6)) AS total_cost FROM charges GROUP BY {columns}"


def _variation(days: int) -> str:
    def span(low: int, high: int) -> str:
        return (f"CAST(sum(CASE WHEN age BETWEEN {low} AND {high} THEN pretax_cost ELSE 0 END) AS DECIMAL(18,6))")

    return f"""
        SELECT service_name, current_cost, previous_cost,
               round((CAST(current_cost AS DOUBLE) - CAST(previous_cost AS DOUBLE))
                     / nullif(CAST(previous_cost AS DOUBLE), 0), 6) AS pct_change
        FROM (SELECT service_name, {span(0, days - 1)} AS current_cost, {span(days, 2 * days - 1)} AS previous_cost
              FROM (SELECT *, (SELECT max(usage_date) FROM charges) - usage_date AS age FROM charges)
              WHERE age BETWEEN 0 AND {2 * days - 1} GROUP BY service_name)"""


def _orphans(child: str, rows: str, column: str, parent: str, parent_rows: str, key: str) -> str:
    return f"""SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table,
        count(DISTINCT {column}) AS orphan_keys, count(*) AS orphan_rows FROM {rows}
        WHERE {column} NOT IN (SELECT {key} FROM {parent_rows})"""


# stored table -> its rows
_STORED = {
    "bronze_eventhub_capture_raw": "ev", "bronze_delivery_batches": "ev",
    "silver_clientes": "s_clientes", "silver_restaurantes": "s_restaurantes", "silver_drivers": "s_drivers",
    "silver_items": "s_items", "silver_orders": "s_orders", "silver_order_items": "s_order_items",
}

# silver table -> its rows before the rules
_UNCHECKED = {
    "silver_clientes": "claimed_clientes", "silver_restaurantes": "claimed_restaurantes",
    "silver_drivers": "claimed_drivers", "silver_items": "claimed_items",
    "silver_orders": "ord_outer", "silver_order_items": "oi_outer",
}

_BODIES: dict[str, str] = {
    "src_capture_stream": _RAW,
    "bronze_raw": _RAW,
    "src_file_lineage": "SELECT count(*) AS rows, count(*) AS rows_with_file, count(*) AS rows_with_time FROM ev",
    "src_path_attrs": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 29 <> 0 THEN 'bus-ns' END AS namespace,
               CASE WHEN o_orderkey % 29 <> 0 THEN 'hub-' || (o_orderkey % 3) END AS event_hub,
               CASE WHEN o_orderkey % 29 <> 0 THEN CAST(o_orderkey % 2 AS INTEGER) END AS partition_id,
               CASE WHEN o_orderkey % 29 <> 0 THEN o_orderdate END AS captured_at FROM orders""",
    "bronze_body_decode": f"""
        SELECT kind, count(*) AS events, count(*) FILTER (WHERE NOT missing) AS bodies,
               count(*) FILTER (WHERE unparsable) AS unparsable,
               count(*) FILTER (WHERE pay = 'CARTÃO CREDITO') AS credit,
               count(*) FILTER (WHERE pay = 'CARTÃO DEBITO') AS debit
        FROM (SELECT kind, missing, unparsable, {_PAY}[CAST(c % 5 AS INTEGER) + 1] AS pay
              FROM (SELECT CAST(seq % 8 AS BIGINT) AS kind, missing, unparsable, CASE WHEN kind = 0 THEN k END AS c
                    FROM ev WHERE kind <> 4
                    UNION ALL SELECT 4, false, false, o_custkey FROM os)) GROUP BY kind""",
    "bronze_parse": f"""
        SELECT seq AS sequence_number, {_HEADER.format('batch_id')} AS batch_id,
               CASE WHEN kind IN (0, 4) THEN 1 END AS n_clientes,
               CASE WHEN kind = 1 THEN CASE WHEN k % 7 = 0 THEN 2 ELSE 1 END END AS n_restaurantes,
               CASE WHEN kind = 2 AND NOT missing AND NOT unparsable THEN 1 END AS n_drivers,
               CASE WHEN kind = 3 THEN CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END END AS n_items,
               CASE WHEN kind = 0 THEN 0 WHEN kind = 4 THEN CASE WHEN k % 211 = 0 THEN 2 ELSE 1 END END AS n_orders
        FROM ev""",
    "bronze_batches": f"""
        SELECT seq AS sequence_number, CAST(seq * 100 AS VARCHAR) AS eventhub_offset,
               {_clock('seq')} AS enqueued_time_utc, {_HEADER.format('batch_id')} AS batch_id,
               {_HEADER.format(_clock('seq'))} AS source_ingestion_ts,
               {_HEADER.format(f'CAST({_clock("seq")} AS DATE)')} AS event_date,
               {_HEADER.format("'delivery_batch_generator'")} AS source_system,
               {_HEADER.format("'1.0'")} AS schema_version FROM ev""",
    "sink_stream_append": f"""
        SELECT seq AS sequence_number, {_HEADER.format('batch_id')} AS batch_id,
               {_HEADER.format(f'CAST({_clock("seq")} AS DATE)')} AS event_date FROM ev""",
    "silver_orders": f"SELECT {_ORDER_COLUMNS}, CAST(len(products) AS INTEGER) AS n_produtos FROM s_orders",
    "silver_orders_dedup": f"""
        SELECT {_ORDER_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY seq % 31536000, seq) AS rn FROM ord)
        WHERE rn = 1 AND {_all_rules('silver_orders')}""",
    "silver_order_items": "SELECT * FROM s_order_items",
    "stream_chain": "SELECT * FROM s_order_items",
    "unnest_outer": " UNION ALL ".join(
        f"SELECT '{n}' AS entity, count(*) AS rows, count(*) FILTER (WHERE {key} IS NULL) AS null_rows FROM outer_{n}"
        for n, (_, key, _) in _FIRST.items()
    ) + " UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE order_id IS NULL) FROM ord_outer",
    "amount_category": """
        SELECT amount_category, count(*) AS orders, min(valor_total) AS least, max(valor_total) AS most
        FROM ord_outer GROUP BY amount_category""",
    "order_date_parts": """
        SELECT order_date, order_year, order_month, order_day, order_hour, count(*) AS orders
        FROM ord_outer GROUP BY order_date, order_year, order_month, order_day, order_hour""",
    "dq_warn": "SELECT seq AS sequence_number, NOT missing AND NOT unparsable AS valid_json_payload FROM ev",
    "dq_drop_orders": "SELECT batch_id, order_id, valor_total, quantidade_total FROM s_orders",
    "dq_drop_order_items": "SELECT batch_id, order_id, item_id, quantidade, valor_total_item FROM s_order_items",
    "dq_metrics_orders": _metrics("ord_outer", "silver_orders"),
    "dq_metrics_order_items": _metrics("oi_outer", "silver_order_items"),
    "dq_fail": "SELECT order_id, valor_total FROM s_orders",
    "dq_quarantine": f"""
        SELECT batch_id, order_id, valor_total, {_broken('silver_orders')} AS failed_rules
        FROM ord_outer WHERE NOT ({_all_rules('silver_orders')})""",
    "dq_row_errors": f"SELECT batch_id, item_id, preco, {_broken('silver_items')} AS failed_rules FROM outer_items",
    "ref_integrity": " UNION ALL ".join((
        _orphans("silver_orders", "s_orders", "client_id", "silver_clientes", "s_clientes", "client_id"),
        _orphans("silver_orders", "s_orders", "merchant_id", "silver_restaurantes", "s_restaurantes", "merchant_id"),
        _orphans("silver_orders", "s_orders", "driver_id", "silver_drivers", "s_drivers", "driver_id"),
        _orphans("silver_order_items", "s_order_items", "item_id", "silver_items", "s_items", "item_id"),
        _orphans("silver_items", "s_items", "merchant_id", "silver_restaurantes", "s_restaurantes", "merchant_id"),
    )),
    "gold_daily_delivery_kpis": _KPIS,
    "sink_mv_refresh": _KPIS,
    "vw_gold_delivery_dashboard": _KPIS,
    "gold_restaurant_performance": _RESTAURANTS,
    "gold_item_category_metrics": _CATEGORIES,
    "layer_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {rows}" for t, rows in _STORED.items()) + """
        UNION ALL SELECT 'gold_daily_delivery_kpis', count(*) FROM
          (SELECT DISTINCT order_date, tipo_pagamento FROM s_orders)
        UNION ALL SELECT 'gold_restaurant_performance', count(*) FROM
          (SELECT DISTINCT order_date, merchant_id FROM s_orders)
        UNION ALL SELECT 'gold_item_category_metrics', count(DISTINCT categoria) FROM s_order_items""",
    "vw_clientes_analyst": """
        SELECT client_id, substr(nome, 1, 1) || '***' AS nome, '***' || right(cpf, 4) AS cpf_mascarado,
               tipo_pagamento, created_at FROM s_clientes""",
    "vw_drivers_analyst": """
        SELECT driver_id, substr(nome, 1, 1) || '***' AS nome, veiculo, '***-' || right(placa, 4) AS placa_mascarada,
               created_at FROM s_drivers""",
    "vw_orders_analytics": """
        SELECT order_id, restaurant_id, quantidade_total, valor_total, tipo_pagamento, order_date, order_year,
               order_month, order_day, order_hour, amount_category FROM s_orders""",
    "mask_by_tag": """
        SELECT batch_id, client_id, substr(nome, 1, 1) || '***' AS nome, substr(endereco, 1, 1) || '***' AS endereco,
               '***' || right(cpf, 4) AS cpf, tipo_pagamento, created_at FROM s_clientes""",
    "mask_by_tag_orders": """
        SELECT order_id, sha256('query-secret' || sha256('query-secret' || client_id)) AS client_id,
               sha256('query-secret' || sha256('query-secret' || driver_id)) AS driver_id, valor_total FROM s_orders""",
    "mask_catalog_table": """
        SELECT batch_id, client_id, substr(nome, 1, 1) || '***' AS nome, substr(endereco, 1, 1) || '***' AS endereco,
               '***' || right(cpf, 4) AS cpf, tipo_pagamento, created_at FROM s_clientes""",
    "layout_clustered": """
        SELECT order_date, restaurant_id, order_id, valor_total FROM s_orders
        WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""",
    "compact_files": """
        SELECT categoria, count(*) AS rows, CAST(sum(valor_total_item) AS DECIMAL(18,2)) AS total
        FROM s_order_items GROUP BY categoria""",
    "retention_keep_bronze": f"""
        SELECT sequence_number, event_date FROM (
          SELECT seq AS sequence_number, {_HEADER.format(f'CAST({_clock("seq")} AS DATE)')} AS event_date,
                 CAST({_clock("seq")} AS DATE) AS enqueued FROM ev)
        WHERE coalesce(event_date, enqueued) >= DATE '2024-12-31' - 90""",
    "retention_keep_silver": """
        SELECT order_id, order_date FROM s_orders WHERE order_date >= DATE '2001-06-30' - 180""",
    "retention_keep_gold": f"SELECT * FROM ({_KPIS}) WHERE metric_date >= DATE '2001-06-30' - 365",
    "cost_reshape": "SELECT * FROM usage",
    "cost_detail": "SELECT * FROM charges",
    "cost_by_resource_daily": f"""
        SELECT {_COST_KEYS}, subscription_id, CAST(sum(pretax_cost) AS DECIMAL(18,6)) AS pretax_cost
        FROM charges GROUP BY {_COST_KEYS}, subscription_id""",
    "cost_summary_daily": "SELECT * FROM summary",
    "cost_write_roundtrip": "SELECT * FROM summary",
    "cost_summary_sorted": "SELECT * FROM summary",
    "cost_lookback": """
        SELECT usage_date, resource_id, meter_subcategory, pretax_cost FROM charges
        WHERE usage_date BETWEEN (SELECT max(usage_date) - 30 FROM charges) AND (SELECT max(usage_date) FROM charges)""",
    "cost_daily_total": _total("usage_date"),
    "cost_by_group": _total("resource_group"),
    "cost_by_type": _total("resource_type"),
    "cost_by_service": _total("service_name"),
    "cost_by_dimension": " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, {c} AS dimension_value, CAST(sum(pretax_cost) AS DECIMAL(18,6)) AS total_cost "
        f"FROM charges GROUP BY {c}" for c in ("resource_group", "resource_type", "service_name")),
    "cost_top_resources": """
        SELECT * FROM (
          SELECT resource_id, total_cost, CAST(rank() OVER (ORDER BY total_cost DESC NULLS LAST) AS INTEGER) AS cost_rank
          FROM (SELECT resource_id, CAST(sum(pretax_cost) AS DECIMAL(18,6)) AS total_cost FROM charges GROUP BY resource_id))
        WHERE cost_rank <= 10""",
    "cost_variation_7d": _variation(7),
    "cost_variation_30d": _variation(30),
    "cost_rolling_7d": """
        SELECT service_name, usage_date, total_cost,
               CAST(sum(total_cost) OVER (PARTITION BY service_name ORDER BY usage_date
                    RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS DECIMAL(18,6)) AS rolling_cost
        FROM (SELECT service_name, usage_date, CAST(sum(pretax_cost) AS DECIMAL(18,6)) AS total_cost
              FROM charges WHERE usage_date IS NOT NULL GROUP BY service_name, usage_date)""",
    "cost_limit_100": """
        SELECT * FROM summary ORDER BY usage_date DESC NULLS LAST, total_cost DESC NULLS LAST,
               resource_group, service_name, currency LIMIT 100""",
    "gen_batches": "SELECT " + ", ".join(f"8 * count(*) AS {c}" for c in (
        "orders", "orders_2_to_4_lines", "orders_distinct_items", "orders_of_own_menu", "orders_total_matches",
        "orders_quantity_matches", "orders_1_to_3_units")) + " FROM events",
    "gen_envelope": """
        SELECT 'delivery_fake_batch' AS event_type, '1.0' AS schema_version, count(*) AS events,
               count(*) AS same_batch_id FROM events""",
    "stream_incremental": " UNION ALL ".join(
        f"SELECT {a} AS after_arrival, '{t}' AS table_name, count(*) AS rows FROM {rows} "
        f"WHERE CAST(CAST({seq} AS BIGINT) // 8 % 2 AS INTEGER) <= {a}"
        for a in (0, 1)
        for t, rows, seq in (("bronze_eventhub_capture_raw", "ev", "seq"), ("bronze_delivery_batches", "ev", "seq"),
                             ("silver_orders", "s_orders", "batch_id"))),
    "stream_rerun_idempotent": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {rows}" for t, rows in _STORED.items()),
    "stream_dedup_state": " UNION ALL ".join(
        f"SELECT 'silver_{n}' AS table_name, count(DISTINCT {key}) AS rows, count(DISTINCT {key}) AS keys FROM {rows}"
        for n, (rows, key, _) in _FIRST.items()),
    "stream_rejected": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, CAST(sum({_broken_count(t)}) AS BIGINT) AS broken_rules "
        f"FROM {rows} WHERE NOT ({_all_rules(t)})"
        for t, rows in _UNCHECKED.items()),
    "maintenance_then_update": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS lakehouse_rows, count(*) AS catalog_rows, "
        f"{'count(*)' if t == 'silver_clientes' else 'CAST(NULL AS BIGINT)'} AS view_rows FROM {rows}"
        for t, rows in _STORED.items() if t in ("silver_clientes", "silver_restaurantes", "silver_drivers", "silver_items")),
    "stream_equals_batch": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS batch_rows, count(*) AS stream_rows, true AS same_content FROM {rows}"
        for t, rows in _STORED.items() if t.startswith("silver")),
}
for _name in _FIRST:
    _table = f"silver_{_name}"
    _BODIES |= {
        _table: f"SELECT * FROM s_{_name}",
        f"{_table}_validate_first": f"SELECT * FROM vf_{_name}",
        f"dedup_first_{_name}": f"SELECT * FROM claimed_{_name}",
        f"dq_drop_{_name}": f"SELECT * FROM outer_{_name} WHERE {_all_rules(_table)}",
        f"dq_metrics_{_name}": _metrics(f"claimed_{_name}", _table),
    }

# an order without products gives one null line in the outer unnest
_CTES["oi_outer"] = """
    SELECT * FROM oi UNION ALL
    SELECT batch_id, order_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM s_orders WHERE len(products) = 0"""


_BODIES["sink_mv_incremental"] = _RESTAURANTS
_BODIES["stream_fail_set"] = " UNION ALL ".join(
    f"SELECT '{state}' AS state, count(*) AS rows FROM s_orders WHERE {held}" for state, held in (
        ("first", "CAST(batch_id AS BIGINT) // 8 % 2 = 0"), ("refused", "CAST(batch_id AS BIGINT) // 8 % 2 = 0"), ("mended", "true")))
_BODIES["dq_rule_history"] = """
    SELECT 'bronze_delivery_batches' AS table_name, 'valid_json_payload' AS rule,
           count(*) FILTER (WHERE NOT missing AND NOT unparsable) AS passed, count(*) FILTER (WHERE missing OR unparsable) AS failed FROM ev
    UNION ALL """ + " UNION ALL ".join(f"SELECT '{table}' AS table_name, rule, passed, failed FROM ({_metrics(rows, table)})" for table, rows in (
        *((f"silver_{n}", f"claimed_{n}") for n in _FIRST), ("silver_orders", "ord_outer"), ("silver_order_items", "oi_outer")))
_BODIES["retention_enforced"] = f"""
    SELECT 'bronze_delivery_batches' AS table_name, count(*) AS rows FROM (
      SELECT CAST({_clock("seq")} AS DATE) AS arrived, {_HEADER.format(f'CAST({_clock("seq")} AS DATE)')} AS event_date FROM ev)
    WHERE coalesce(event_date, current_date) >= DATE '2024-12-31' - 90
    UNION ALL SELECT 'silver_orders', count(*) FROM s_orders WHERE order_date >= date_trunc('month', DATE '2001-06-30' - 180)
    UNION ALL SELECT 'gold_daily_delivery_kpis', count(*) FROM ({_KPIS}) WHERE metric_date >= date_trunc('month', DATE '2001-06-30' - 365)
    UNION ALL SELECT 'gold_restaurant_performance', count(*) FROM ({_RESTAURANTS})
    WHERE order_date >= date_trunc('month', DATE '2001-06-30' - 365)"""
_BODIES["stream_split_equals_batch"] = _BODIES["stream_equals_batch"]


def oracle() -> dict[str, str]:
    return {name: sql(body) for name, body in _BODIES.items()}
