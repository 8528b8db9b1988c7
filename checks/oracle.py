"""Expected results as DuckDB SQL over the raw test tables.

The statements start from the flat tables, not from the nested stand-ins, and share building
blocks: a block is a named relation, and a statement pulls in those it mentions.
"""

from __future__ import annotations

import re

from shelfwise.columns import SLOT_ATTRIBUTES

MARKET = (
    "CASE {k} % 24 WHEN 4 THEN 'TB_AE' WHEN 7 THEN 'HS_SA' WHEN 10 THEN 'FP_PK' "
    "WHEN 13 THEN 'EF_GR' ELSE CASE WHEN {k} % 2 = 0 THEN 'GV_ES' ELSE 'PY_AR' END END"
)
ALL = (
    "(VALUES ('GV_ES'), ('PY_AR'), ('TB_AE'), ('HS_SA'), ('FP_PK'), ('EF_GR')) AS markets(ge)"
)
IN_WINDOW = "BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"
# Through text, a number keeps the digits it is shown with, however it is stored.
R2 = "round(({x})::DOUBLE::VARCHAR::DECIMAL(38,15), 2)::DOUBLE"
EXACT = "({x})::VARCHAR::DECIMAL(38,15)"
EUR = "(sum({x}))::VARCHAR::DOUBLE"


def market(key: str) -> str:
    return MARKET.format(k=key)


def r2(x: str) -> str:
    return R2.format(x=x)


def exact(x: str) -> str:
    return EXACT.format(x=x)


def eur(x: str) -> str:
    return EUR.format(x=exact(x))


def ratio(num: str, den: str) -> str:
    return f"(({num})::DOUBLE / nullif(({den})::DOUBLE, 0))"


def _platform(column: str) -> str:
    return (
        f"CASE {column} WHEN 'PY_AR' THEN 'py' WHEN 'TB_AE' THEN 'tb' WHEN 'HS_SA' THEN 'hs' "
        "WHEN 'GV_ES' THEN 'gv' WHEN 'FP_PK' THEN 'pd' WHEN 'EF_GR' THEN 'ef' END"
    )


BLOCKS = {
    # ---- inputs, flat -------------------------------------------------------------------------
    "t_vendor": f"""
        SELECT {market('s_suppkey')} AS ge, m.month, s_suppkey AS v, s_name AS vname,
               nullif(s_suppkey % 7, 0) AS chain,
               'Chain ' || nullif(s_suppkey % 7, 0) AS chain_name,
               if(s_suppkey % 9 = 8, 'Dark Store', 'Shop') AS vertical,
               if(s_suppkey % 4 = 3, 'kiosk', 'grocery') AS seg,
               'C' || ((s_suppkey // 2) % 2) AS city,
               CASE s_suppkey % 13 WHEN 12 THEN true WHEN 5 THEN NULL ELSE false END AS is_key,
               s_suppkey % 17 <> 16 AS online,
               CASE WHEN s_suppkey % 11 = 0 THEN NULL
                    ELSE ((s_suppkey * 7919) % 900 + 100) * m.factor END AS sessions,
               CASE WHEN m.factor = 2 THEN 1.0::DOUBLE
                    WHEN s_acctbal > 0 THEN s_acctbal * 100 END AS gmv,
               ((s_suppkey * 31) % 101)::DOUBLE AS score
        FROM supplier,
             (VALUES (DATE '1999-12-01', 1), (DATE '1999-11-01', 2)) AS m(month, factor)""",
    "t_month": "SELECT * FROM t_vendor WHERE month = DATE '1999-12-01'",
    "t_listing": f"""
        SELECT ge, p_partkey - p_partkey % 2 AS m, p_partkey AS p,
               788918400 + p_size * 86400 + p_partkey AS created FROM part, {ALL}
        UNION ALL
        SELECT ge, p_partkey - p_partkey % 2, NULL, 788918400 + p_size * 86400 + p_partkey
        FROM part, {ALL}
        UNION ALL
        SELECT ge, p_partkey - p_partkey % 2 + 2, p_partkey,
               if(p_partkey % 3 = 0, NULL, 631152000) FROM part, {ALL}""",
    "t_demand": f"""
        SELECT ge, p_partkey AS m, min(p_partkey) OVER (PARTITION BY ge, p_name, p_brand, p_type)
               AS a, p_name, p_brand, p_type
        FROM part, {ALL} WHERE p_partkey % 2 = 0 AND p_partkey % 22 <> 4""",
    "t_supply": f"""
        SELECT ge, p_partkey AS m, min(p_partkey) OVER (PARTITION BY ge, p_name, p_brand) AS a
        FROM part, {ALL} WHERE p_partkey % 2 = 0 AND p_partkey % 26 <> 6""",
    "t_rate": f"""
        SELECT {market('l_suppkey')} AS ge, l_suppkey AS v, l_partkey AS p,
               l_shipdate::DATE AS day, if(l_returnflag = 'R', 1 - l_discount, 0.0) AS rate
        FROM lineitem""",
    "t_order": f"""
        SELECT {market('l_suppkey')} AS ge, l_suppkey AS v, l_partkey AS p,
               o_orderdate::DATE AS day, o_orderstatus <> 'P' AS ok,
               CASE o_orderkey % 10 WHEN 0 THEN 'darkstores' WHEN 1 THEN NULL ELSE 'shop' END
               AS vt, l_quantity::BIGINT AS qty, l_extendedprice * (1 - l_discount) AS paid
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "t_order_item": """
        SELECT ge, v, day, ok, vt, p, qty - qty // 2 AS qty, paid FROM t_order
        UNION ALL
        SELECT ge, v, day, ok, vt, p, qty // 2, NULL FROM t_order WHERE qty > 1""",
    "t_user_node": f"""
        WITH c AS (SELECT c_custkey AS k, (SELECT count(*) FROM supplier) AS n FROM customer),
        n AS (SELECT k, k % n AS vendor FROM c WHERE k % 29 <> 0
              UNION ALL SELECT k, (k + 1) % n FROM c WHERE k % 29 <> 0 AND k % 5 = 0)
        SELECT 'U' || c.k AS uuid, c.k % 23 = 0 AS user_gone, n.vendor,
               {market('n.vendor')} AS ge0,
               CASE WHEN n.vendor IS NULL THEN NULL WHEN c.k % 19 = 0 THEN true
                    WHEN c.k % 3 <> 0 THEN false END AS node_gone
        FROM c LEFT JOIN n ON c.k = n.k""",
    "t_node": """
        SELECT uuid, user_gone, vendor, if(vendor IS NULL, NULL, ge0) AS ge, node_gone
        FROM t_user_node""",
    "t_attribute": """
        SELECT 'U' || c_custkey AS uuid, nullif(c_mktsegment, 'HOUSEHOLD') AS food,
               if(c_custkey % 2 = 0, 'owner', 'staff') AS cd_role, c_custkey % 5 = 0 AS multi
        FROM customer""",
    "t_threshold": """
        SELECT ge, 'grocery' AS seg, (max(n) + 0.75)::DOUBLE AS bar FROM (
            SELECT ge, v, count(*) AS n FROM (
                SELECT ge, v, p FROM t_rate
                WHERE day BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
                GROUP BY ge, v, p HAVING sum(rate) > 0) GROUP BY ge, v) GROUP BY ge""",
    # ---- alias tables -------------------------------------------------------------------------
    "t_owner": """
        SELECT ge, p, arg_min(m, (coalesce(-created, 9999999999), m)) AS m
        FROM t_listing WHERE m IS NOT NULL AND p IS NOT NULL GROUP BY ge, p""",
    "t_lookup": """
        SELECT o.ge, o.p, d.a AS d, s.a AS s FROM t_owner AS o
        LEFT JOIN t_demand AS d USING (ge, m) LEFT JOIN t_supply AS s USING (ge, m)""",
    "t_bridge": """
        SELECT DISTINCT ge, d.a AS d, s.a AS s
        FROM t_demand AS d JOIN t_supply AS s USING (ge, m)""",
    "t_meta": """
        SELECT ge, m AS a, concat_ws(' ', p_name, p_brand) AS alias_name,
               if(m % 3 = 0, NULL, p_name) AS local_name,
               concat_ws(' ', p_type, p_name) AS english_name,
               lpad(m::VARCHAR, 13, '0') AS barcode, '/img/' || m AS image
        FROM t_demand WHERE m = a""",
    # ---- vendors ------------------------------------------------------------------------------
    "t_dim": """
        SELECT DISTINCT ge, v, vname, chain, chain_name, seg, city, is_key, sessions, gmv, score
        FROM t_month
        WHERE NOT contains(lower(vertical), 'dark') AND NOT coalesce(is_key, false) AND online""",
    "t_total": """
        SELECT ge, v, max(coalesce(sessions, 0)) AS sessions, max(coalesce(gmv, 0)) AS gmv,
               max(coalesce(score, 0)) AS score FROM t_dim GROUP BY ge, v""",
    "t_link": """
        SELECT DISTINCT uuid, vendor, ge FROM t_node
        WHERE NOT coalesce(user_gone, false) AND NOT coalesce(node_gone, false)""",
    "t_contact": """
        SELECT ge, vendor AS v, uuid, food, cd_role, multi
        FROM t_link JOIN t_attribute USING (uuid) WHERE food IS NOT NULL""",
    # ---- assortment and demand ----------------------------------------------------------------
    "t_active": f"""
        SELECT ge, v, p FROM t_rate WHERE day {IN_WINDOW}
        GROUP BY ge, v, p HAVING sum(rate) > 0""",
    "t_skus": "SELECT ge, v, count(*) AS n FROM t_active GROUP BY ge, v",
    "t_catalog": """
        SELECT DISTINCT ge, v, s AS a, seg, city, vname, chain
        FROM t_active JOIN t_dim USING (ge, v) JOIN t_lookup USING (ge, p) WHERE s IS NOT NULL""",
    "t_product": """
        SELECT DISTINCT ge, v, p, d AS a, seg, city, chain
        FROM t_active JOIN t_dim USING (ge, v) JOIN t_lookup USING (ge, p) WHERE d IS NOT NULL""",
    "t_item": f"SELECT * FROM t_order_item WHERE ok AND day {IN_WINDOW}",
    "t_sale": f"""
        SELECT ge, v, chain, seg, city, a, sum(qty)::BIGINT AS qty,
               sum({exact('coalesce(paid, 0)')}) AS rev
        FROM t_item JOIN t_product USING (ge, v, p) GROUP BY ALL""",
    # The job's own grains: known vendors, groups once per product, cells after the vendor's sums.
    "t_known": """
        SELECT ge, v, p FROM t_active SEMI JOIN t_dim USING (ge, v)""",
    "t_face": "SELECT DISTINCT ge, v, vname, seg, city, chain FROM t_dim",
    "t_side": """
        SELECT DISTINCT ge, p, 'demand' AS side, d AS a FROM t_lookup WHERE d IS NOT NULL
        UNION ALL SELECT DISTINCT ge, p, 'supply', s FROM t_lookup WHERE s IS NOT NULL""",
    "t_sold": f"""
        SELECT ge, v, a, sum(qty)::BIGINT AS qty, sum({exact('coalesce(paid, 0)')}) AS rev
        FROM t_item JOIN t_known USING (ge, v, p)
        JOIN (SELECT ge, p, a FROM t_side WHERE side = 'demand') USING (ge, p) GROUP BY ge, v, a""",
    "t_presence": """
        SELECT ge, v, seg, city, any_value(sessions) AS sessions, count(*) AS chain_rows
        FROM (SELECT DISTINCT ge, v, seg, city, chain FROM t_dim) JOIN t_total USING (ge, v)
        GROUP BY ge, v, seg, city""",
    "t_metric": f"""
        SELECT ge, seg, city, a, sum(qty)::BIGINT AS qty, {eur('rev')} AS rev,
               count(DISTINCT v) AS sellers,
               {ratio(eur('rev'), 'count(DISTINCT v)')} AS avg_rev,
               {ratio('sum(qty)', 'count(DISTINCT v)')} AS avg_qty,
               {ratio(eur('rev'), 'sum(sessions)')} AS rate
        FROM t_sale LEFT JOIN t_total USING (ge, v) GROUP BY ge, seg, city, a""",
    "t_gated": "SELECT * FROM t_metric WHERE avg_rev >= 100 AND avg_qty > 1",
    "t_carrier": """
        SELECT x.*, b.s, c.v, c.chain
        FROM t_gated AS x JOIN t_bridge AS b ON b.ge = x.ge AND b.d = x.a
        JOIN t_catalog AS c ON c.ge = x.ge AND c.a = b.s AND c.seg = x.seg AND c.city = x.city""",
    "t_counted": """
        SELECT ge, seg, city, a, any_value(qty) AS qty, any_value(rev) AS rev,
               any_value(sellers) AS sellers, any_value(avg_rev) AS avg_rev,
               any_value(avg_qty) AS avg_qty, any_value(rate) AS rate,
               count(DISTINCT chain) AS chains
        FROM t_carrier GROUP BY ge, seg, city, a""",
    "t_candidate": "SELECT * FROM t_counted WHERE chains >= 2",
    "t_top": """
        SELECT * FROM (SELECT *, rank() OVER (PARTITION BY ge, seg, city ORDER BY qty DESC) AS rk
                       FROM t_candidate) WHERE rk <= 10""",
    # ---- gaps ---------------------------------------------------------------------------------
    "t_pair": """
        SELECT t.*, w.v, w.vname FROM t_top AS t
        JOIN (SELECT DISTINCT ge, v, vname, seg, city FROM t_catalog) AS w USING (ge, seg, city)""",
    "t_carried": """
        SELECT DISTINCT c.ge, c.v, b.d AS a FROM t_catalog AS c
        JOIN t_bridge AS b ON b.ge = c.ge AND b.s = c.a""",
    "t_missing": "SELECT * FROM t_pair AS x ANTI JOIN t_carried AS y USING (ge, v, a)",
    "t_gap": f"""
        SELECT x.*, coalesce(t.sessions, 0) AS vsessions,
               {r2('x.rate * coalesce(t.sessions, 0)')} AS est,
               coalesce(t.gmv, 0) AS gmv, coalesce(t.score, 0) AS score
        FROM t_missing AS x LEFT JOIN t_total AS t USING (ge, v)""",
    "t_best": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY ge, seg, city, v ORDER BY rk, a, vname)
            AS nth FROM t_gap) WHERE nth <= 3""",
    "t_shown": """
        SELECT b.*, alias_name, local_name, english_name, barcode, image
        FROM t_best AS b LEFT JOIN t_meta USING (ge, a)""",
}

_SLOT_SOURCE = {
    "alias_product_id": "a", "product_name_alias": "alias_name", "product_name_en": "english_name",
    "product_name_local": "local_name", "market_rank": "rk", "market_qty_sold": "qty",
    "flat_avg_rev_eur": r2("avg_rev"), "weighted_est_rev_eur": "est", "num_chains": "chains",
    "barcode": "barcode", "image_url": "image",
}
_SLOTS = ", ".join(
    f"max({_SLOT_SOURCE[attribute]}) FILTER (WHERE nth = {n}) AS gap{n}_{attribute}"
    for n in (1, 2, 3) for attribute in SLOT_ATTRIBUTES
)
_EST = " + ".join(f"coalesce(gap{n}_weighted_est_rev_eur, 0)" for n in (1, 2, 3))

BLOCKS |= {
    "t_wide": f"""
        SELECT ge, seg, city, v, vname, vsessions, max(gmv) AS gmv, max(score) AS score, {_SLOTS}
        FROM t_shown GROUP BY ge, seg, city, v, vname, vsessions""",
    "t_priced": f"""
        SELECT *, {r2(_EST)} AS total, {r2(ratio(_EST, 'gmv') + ' * 100')} AS pct FROM t_wide""",
    "t_flagged": """
        SELECT p.*, coalesce(k.n, 0) AS skus, coalesce(h.bar, 0) AS bar,
               coalesce(score >= 50 AND pct >= 1
                   AND coalesce(k.n, 0) >= 0.8::DOUBLE * coalesce(h.bar, 999999), false) AS uc1,
               coalesce(score >= 50
                   AND coalesce(k.n, 0) < 0.8::DOUBLE * coalesce(h.bar, 999999), false) AS uc2
        FROM t_priced AS p LEFT JOIN t_skus AS k USING (ge, v)
        LEFT JOIN t_threshold AS h USING (ge, seg)""",
    "t_result": "SELECT * FROM t_flagged JOIN t_contact USING (ge, v)",
    "t_grain": "SELECT DISTINCT ge, seg, city, v, vname, vsessions, total FROM t_result WHERE uc1",
    "t_turnover": """
        SELECT ge, v, coalesce(bool_or(is_key), false) AS is_key, max(coalesce(gmv, 0)) AS gmv
        FROM t_month GROUP BY ge, v""",
    "t_short": """
        SELECT ge, v, bool_or(coalesce(n, 0) < 0.8::DOUBLE * coalesce(bar, 999999)) AS short
        FROM (SELECT DISTINCT ge, v, seg FROM t_dim) LEFT JOIN t_skus USING (ge, v)
        LEFT JOIN t_threshold USING (ge, seg) GROUP BY ge, v""",
    "t_compliance": f"""
        SELECT ge, count(*) AS vendors, count_if(short)::BIGINT AS below,
               {r2(ratio('count_if(short)', 'count(*)') + ' * 100')} AS pct
        FROM t_short GROUP BY ge""",
}

_GE = "ge AS global_entity_id"
_V = "v AS platform_vendor_id"
_CELL = f"{_GE}, seg AS vertical_segment, city"
_SKU = f"{_GE}, {_V}, p AS platform_product_id"
_GROUP = f"{_CELL}, a AS alias_product_id"
_ALIAS = f"SELECT {_GE}, m AS catalog_master_product_id, a AS alias_product_id FROM "
_METRICS = (
    "qty AS total_quantity_sold, rev AS total_revenue_eur, sellers AS num_vendors_sold, "
    "avg_rev AS flat_avg_revenue_eur, avg_qty AS flat_avg_qty, rate AS rev_per_session"
)
_TOP = f"{_GROUP}, {_METRICS}, chains AS num_chains, rk AS sku_rank"
_PAIR = f"{_TOP}, {_V}, vname AS vendor_name"
_CONTEXT = (
    "vsessions AS vendor_sessions, est AS weighted_est_revenue_eur, gmv AS vendor_gmv_eur, "
    "score AS vps_v11"
)
_META = (
    "alias_name AS catalog_master_product_name_alias, local_name AS product_name_local, "
    "english_name AS product_name_english, barcode AS primary_barcode, image AS product_image_url"
)
_DIM = (
    f"{_GE}, {_V}, vname AS vendor_name, chain AS chain_id, chain_name, "
    "seg AS vertical_segment, city, is_key AS is_key_partner, sessions AS menu_sessions, "
    "gmv AS gmv_eur, score AS vps_v11"
)
_VENDOR_ROW = f"SELECT {_DIM}, vertical, online AS is_online FROM "
_LOOKUP = f"SELECT {_GE}, p AS platform_product_id, d AS demand_alias_id, s AS supply_alias_id"
_CATALOG = (
    f"SELECT {_GE}, {_V}, a AS alias_product_id, seg AS vertical_segment, city, "
    "vname AS vendor_name, chain AS chain_id FROM t_catalog"
)
_PRODUCT = (
    f"SELECT {_SKU}, a AS alias_product_id, seg AS vertical_segment, city, chain AS chain_id "
    "FROM t_product"
)
_SALE = (
    f"{_GE}, {_V}, chain AS chain_id, seg AS vertical_segment, city, a AS alias_product_id, "
    "qty AS quantity_sold, rev::VARCHAR::DOUBLE AS revenue_eur"
)
_SOLD = (
    f"{_GE}, {_V}, a AS alias_product_id, qty AS quantity_sold, rev::VARCHAR::DOUBLE AS revenue_eur"
)
_NODE = "SELECT uuid, user_gone AS is_deleted, vendor AS vendor_code, ge AS global_entity_id, "
_NODE += "node_gone AS node_is_deleted FROM t_node"
_ITEM = f"SELECT {_SKU}, qty AS quantity_sold, paid AS total_amt_paid_eur FROM "
_SLOT_NAMES = ", ".join(f"gap{n}_{a}" for n in (1, 2, 3) for a in SLOT_ATTRIBUTES)
_WIDE = (
    f"{_CELL}, {_V}, vname AS vendor_name, vsessions AS vendor_sessions, gmv AS vendor_gmv_eur, "
    f"{_SLOT_NAMES}, total AS total_weighted_est_rev_eur, pct AS pct_of_vendor_gmv, "
    "score AS vps_v11"
)
_FLAGS = (
    "skus AS vendor_active_skus, bar AS mature_threshold, uc1 AS targeted_usecase1, "
    "uc2 AS targeted_usecase2"
)
_PEOPLE = (
    "uuid, food AS va_vertical_food, cd_role, multi AS cd_is_multi_vendor_user"
)
_RESULT = f"{_WIDE}, {_FLAGS}, {_PEOPLE}"
_KEYED_PAIRS = f"{_CELL}, {_V}, a AS alias_product_id"

STATEMENTS = {
    "scan_alias_demand": _ALIAS + "t_demand",
    "scan_alias_supply": _ALIAS + "t_supply",
    "scan_catalog": f"""SELECT {_GE}, m AS catalog_master_product_id, p AS platform_product_id,
        created AS created_second FROM t_listing WHERE p IS NOT NULL""",
    "scan_vendor_month": _VENDOR_ROW + "t_month",
    "scan_buyable_rate": f"""SELECT {_SKU}, rate AS daily_buyable_rate_eligible_ref
        FROM t_rate WHERE day {IN_WINDOW}""",
    "scan_orders": _ITEM + "t_item",
    "scan_vendor_users": _NODE,
    "scan_comms_attributes": f"SELECT {_PEOPLE} FROM t_attribute",
    "scan_sku_threshold": f"""SELECT {_GE}, seg AS vertical_segment, bar AS mature_threshold
        FROM t_threshold""",
    "scan_lookup_tables": f"""
        SELECT 'lookup' AS table_name, {_GE}, p AS id1, d AS id2, s AS id3 FROM t_lookup
        UNION ALL SELECT 'bridge', ge, d, s, NULL FROM t_bridge
        UNION ALL SELECT 'metadata', ge, a, NULL, NULL FROM t_meta""",
    "build_product_alias_lookup": f"{_LOOKUP} FROM t_lookup",
    "build_demand_supply_bridge": f"""SELECT {_GE}, d AS demand_alias_id, s AS supply_alias_id
        FROM t_bridge""",
    "build_product_metadata": f"SELECT {_GE}, a AS alias_product_id, {_META} FROM t_meta",
    "write_gap_result": f"SELECT {_RESULT} FROM t_result",
    # ---- filters ------------------------------------------------------------------------------
    "filter_entity_in": _VENDOR_ROW + "t_vendor WHERE ge IN ('GV_ES', 'GV_IT')",
    "filter_entity_prefix": _ALIAS + "t_demand WHERE ge LIKE 'GV_%'",
    "filter_no_entity": _VENDOR_ROW + "t_vendor",
    "filter_report_month": _VENDOR_ROW + "t_vendor WHERE month = DATE '1999-11-01'",
    "filter_previous_month": _VENDOR_ROW + """t_vendor
        WHERE month = date_trunc('month', DATE '2000-01-15' - INTERVAL 1 MONTH)""",
    "filter_date_range": f"SELECT {_SKU}, day AS date_ref FROM t_rate WHERE day {IN_WINDOW}",
    "filter_rolling_30d": f"""SELECT {_SKU}, day AS date_ref FROM t_rate
        WHERE day BETWEEN DATE '1998-06-30' - 29 AND DATE '1998-06-30'""",
    "filter_not_dark": _VENDOR_ROW + "t_vendor WHERE lower(vertical) NOT LIKE '%dark%'",
    "filter_not_key_partner": _VENDOR_ROW + "t_vendor WHERE is_key IS DISTINCT FROM true",
    "filter_online": _VENDOR_ROW + "t_vendor WHERE coalesce(online, false)",
    "filter_successful_orders": f"""SELECT {_GE}, {_V}, day AS order_created_date_lt
        FROM t_order WHERE coalesce(ok, false)""",
    "filter_vertical_type": f"""SELECT {_GE}, {_V}, vt AS vertical_type
        FROM t_order WHERE vt <> 'darkstores'""",
    "filter_soft_deleted": _NODE
    + " WHERE NOT coalesce(user_gone, false) AND NOT coalesce(node_gone, false)",
    "filter_not_null_keys": f"""SELECT {_GE}, m AS catalog_master_product_id,
        p AS platform_product_id FROM t_listing WHERE m IS NOT NULL AND p IS NOT NULL""",
    "filter_primary_product": _ALIAS + "t_demand WHERE m = a",
    "filter_has_vertical_food": f"SELECT {_GE}, {_V}, {_PEOPLE} FROM t_contact",
    "project_rename": f"""SELECT {_GE}, a AS alias_product_id,
        if(m % 3 = 0, NULL, p_name) AS product_name_local,
        concat_ws(' ', p_type, p_name) AS product_name_english,
        '/img/' || m AS product_image_url FROM t_demand""",
    # ---- nested -------------------------------------------------------------------------------
    "unnest_catalog": f"""SELECT {_GE}, m AS catalog_master_product_id, p AS platform_product_id
        FROM t_listing""",
    "unnest_order_items": _ITEM + "t_order_item",
    "unnest_vendor_nodes_outer": _NODE,
    "struct_field_access": "SELECT paid AS total_amt_paid_eur FROM t_order_item",
    # ---- joins --------------------------------------------------------------------------------
    "join_catalog_alias_left": f"{_LOOKUP} FROM t_lookup",
    "join_catalog_alias_inner": f"""SELECT DISTINCT {_GE}, p AS platform_product_id,
        a AS alias_product_id FROM t_owner JOIN t_demand USING (ge, m)""",
    "join_bridge": f"""SELECT {_GE}, m AS catalog_master_product_id, d.a AS demand_alias_id,
        s.a AS supply_alias_id FROM t_demand AS d JOIN t_supply AS s USING (ge, m)""",
    "join_vendor_catalog": f"""SELECT {_SKU}, a AS alias_product_id, vname AS vendor_name,
        seg AS vertical_segment, city, chain AS chain_id
        FROM t_known JOIN t_side USING (ge, p) JOIN t_face USING (ge, v) WHERE side = 'supply'""",
    "join_vendor_demand_products": _PRODUCT,
    "join_order_items": f"""SELECT {_SKU}, a AS alias_product_id, seg AS vertical_segment, city,
        chain AS chain_id, sum(qty)::BIGINT AS quantity_sold,
        {eur('coalesce(paid, 0)')} AS revenue_eur
        FROM t_item JOIN t_product USING (ge, v, p) GROUP BY ALL""",
    "join_sales_sessions": f"""SELECT {_SOLD}, seg AS vertical_segment, city,
        sessions AS menu_sessions, chain_rows FROM t_sold JOIN t_presence USING (ge, v)""",
    "join_candidates_chain": f"""SELECT {_GROUP}, s AS supply_alias_id, {_V}, chain AS chain_id
        FROM t_carrier""",
    "join_top_to_vendors": f"SELECT {_PAIR} FROM t_pair",
    "join_vendor_context": f"""
        SELECT {_PAIR}, coalesce(t.sessions, 0) AS vendor_sessions,
               {r2('rate * coalesce(t.sessions, 0)')} AS weighted_est_revenue_eur,
               coalesce(t.gmv, 0) AS vendor_gmv_eur, coalesce(t.score, 0) AS vps_v11
        FROM t_pair LEFT JOIN t_total AS t USING (ge, v)""",
    "antijoin_gap": f"SELECT {_PAIR} FROM t_missing",
    "join_metadata": f"SELECT {_PAIR}, {_CONTEXT}, nth AS vendor_gap_rank, {_META} FROM t_shown",
    "join_targeting": f"SELECT {_RESULT} FROM t_result",
    # ---- aggregations -------------------------------------------------------------------------
    "distinct_vendor_dims": f"SELECT {_DIM} FROM t_dim",
    "agg_vendor_sessions": f"SELECT {_GE}, {_V}, sessions AS menu_sessions FROM t_total",
    "agg_vendor_gmv_score": f"""SELECT {_GE}, {_V}, gmv AS gmv_eur, score AS vps_v11
        FROM t_total""",
    "agg_active_skus": f"SELECT {_SKU} FROM t_active",
    "agg_vendor_sku_count": f"SELECT {_GE}, {_V}, n AS vendor_active_skus FROM t_skus",
    "distinct_vendor_catalog": _CATALOG,
    "distinct_vendor_demand_products": _PRODUCT,
    "distinct_bridge": f"""SELECT {_GE}, d AS demand_alias_id, s AS supply_alias_id
        FROM t_bridge""",
    "distinct_metadata": f"SELECT {_GE}, a AS alias_product_id, {_META} FROM t_meta",
    "distinct_vendors_by_dim": f"""SELECT DISTINCT {_CELL}, {_V}, vname AS vendor_name
        FROM t_catalog""",
    "distinct_vendor_users": f"SELECT uuid, vendor AS vendor_code, {_GE} FROM t_link",
    "agg_vendor_product_sales": f"SELECT {_SALE} FROM t_sale",
    "agg_market_metrics": f"SELECT {_GROUP}, {_METRICS} FROM t_metric",
    "having_quality_gate": f"""SELECT {_GROUP}, {_METRICS} FROM t_metric
        WHERE avg_rev >= 60000 AND avg_qty > 20""",
    "agg_chain_count": f"SELECT {_GROUP}, {_METRICS}, chains AS num_chains FROM t_counted",
    "having_private_label": f"SELECT {_GROUP}, {_METRICS}, chains AS num_chains FROM t_candidate",
    "pivot_top3": f"SELECT {_WIDE} FROM t_priced",
    "agg_total_gap_revenue": f"""SELECT {_KEYED_PAIRS.replace(', a AS alias_product_id', '')},
        total AS total_weighted_est_rev_eur FROM t_priced""",
    "agg_pct_of_gmv": f"""SELECT {_KEYED_PAIRS.replace(', a AS alias_product_id', '')},
        pct AS pct_of_vendor_gmv FROM t_priced""",
    # ---- windows ------------------------------------------------------------------------------
    "dedup_latest_catalog": f"""SELECT {_GE}, p AS platform_product_id,
        m AS catalog_master_product_id FROM t_owner""",
    "rank_top10": f"SELECT {_TOP} FROM t_top",
    "rank_gap_top3": f"SELECT {_PAIR}, {_CONTEXT}, nth AS vendor_gap_rank FROM t_best",
    "qualify": f"""SELECT {_CELL}, {_V}, gmv AS gmv_eur, nth AS turnover_rank FROM (
        SELECT *, row_number() OVER (PARTITION BY ge, seg, city ORDER BY gmv DESC NULLS LAST, v)
        AS nth FROM t_dim) WHERE nth <= 5""",
    "order_result": f"""SELECT {_RESULT}, row_number() OVER (ORDER BY ge, seg, city, v, vname, uuid,
        food, cd_role, multi) AS position FROM t_result""",
    # ---- expressions --------------------------------------------------------------------------
    "safe_divide": f"SELECT {_GE}, {_V}, month AS report_month, "
    f"{ratio('gmv', 'coalesce(sessions, 0)')} AS gmv_per_session FROM t_vendor",
    "coalesce_default": f"""SELECT {_GE}, {_V}, month AS report_month,
        coalesce(sessions, 0) AS menu_sessions, coalesce(is_key, false) AS is_key_partner,
        coalesce(chain, 999999) AS chain_id FROM t_vendor""",
    "round2": f"SELECT {_SKU}, {r2('paid')} AS paid_eur FROM t_order_item",
    "lower_not_like": f"""SELECT {_GE}, {_V}, month AS report_month,
        lower(vertical) NOT LIKE '%dark%' AS is_shop FROM t_vendor""",
    "case_when": f"""SELECT {_GE}, {_V}, month AS report_month,
        CASE WHEN score >= 50 AND gmv > 0 THEN true ELSE false END AS healthy,
        CASE WHEN seg = 'kiosk' THEN sessions END AS kiosk_sessions FROM t_vendor""",
    "date_arith": """SELECT o_orderkey,
        date_trunc('month', o_orderdate)::DATE AS month_start,
        date_trunc('month', o_orderdate - INTERVAL 1 MONTH)::DATE AS previous_month,
        o_orderdate::DATE - 29 AS window_start FROM orders""",
    "weighted_est_revenue": f"""SELECT {_KEYED_PAIRS}, est AS weighted_est_revenue_eur
        FROM t_gap""",
    "targeted_usecase1": f"""SELECT {_CELL}, {_V}, uc1 AS targeted_usecase1 FROM t_flagged""",
    "targeted_usecase2": f"""SELECT {_CELL}, {_V}, uc2 AS targeted_usecase2 FROM t_flagged""",
    # ---- jobs ---------------------------------------------------------------------------------
    "lookup_refresh": f"""
        SELECT 'lookup' AS table_name, {_GE}, count(*) AS n_rows,
               count(DISTINCT d) AS n_ids FROM t_lookup GROUP BY ge
        UNION ALL SELECT 'bridge', ge, count(*), count(DISTINCT d) FROM t_bridge GROUP BY ge
        UNION ALL SELECT 'metadata', ge, count(*), count(DISTINCT a) FROM t_meta GROUP BY ge""",
    "gap_v1": f"SELECT {_RESULT} FROM t_result WHERE starts_with(ge, 'PY')",
    "gap_platform_preset": f"SELECT {_platform('ge')} AS platform, {_RESULT} FROM t_result",
    "gap_all": f"SELECT {_RESULT} FROM t_result",
    "gap_v2": f"SELECT {_RESULT} FROM t_result WHERE starts_with(ge, 'GV')",
    # ---- reports ------------------------------------------------------------------------------
    "report_opportunity_by_entity": f"""SELECT {_platform('ge')} AS platform, {_GE},
        {eur('total')} AS estimated_revenue_eur FROM t_grain GROUP BY ge""",
    "report_opportunity_by_platform": f"""
        SELECT platform, estimated_revenue_eur FROM (
            SELECT {_platform('ge')} AS platform, {eur('total')} AS estimated_revenue_eur
            FROM t_grain GROUP BY ALL)
        UNION ALL SELECT 'Total', {eur('total')} FROM t_grain""",
    "report_opportunity_share": f"""
        WITH g AS (SELECT coalesce({eur('total')}, 0) AS opp FROM t_grain),
        w AS (SELECT {eur('gmv')} AS everyone, {eur('if(is_key, 0, gmv)')} AS nkp FROM t_turnover)
        SELECT opp AS total_opportunity_eur,
               {r2(ratio('opp', 'nkp') + ' * 100')} AS pct_of_nkp_gmv,
               {r2(ratio('opp', 'everyone') + ' * 100')} AS pct_of_all_gmv,
               nkp AS nkp_gmv_eur, everyone AS all_gmv_eur FROM g, w""",
    "report_gmv_by_partner_type": f"""
        WITH w AS (SELECT {_platform('ge')} AS platform, * FROM t_turnover)
        SELECT platform, {eur('if(is_key, 0, gmv)')} AS nkp_gmv_eur,
               {eur('if(is_key, gmv, 0)')} AS key_partner_gmv_eur, {eur('gmv')} AS total_gmv_eur
        FROM w GROUP BY platform
        UNION ALL
        SELECT 'Total', {eur('if(is_key, 0, gmv)')}, {eur('if(is_key, gmv, 0)')}, {eur('gmv')}
        FROM w""",
    "report_min_sku_compliance": f"""SELECT {_platform('ge')} AS platform, {_GE},
        vendors AS total_vendors, below AS below_threshold, pct AS pct_below FROM t_compliance""",
    "report_compliance_extremes": f"""
        (SELECT 'highest_pct' AS kind, {_GE}, pct AS pct_below, below AS below_threshold
         FROM t_compliance ORDER BY pct DESC, ge LIMIT 1)
        UNION ALL (SELECT 'lowest_pct', ge, pct, below FROM t_compliance ORDER BY pct, ge LIMIT 1)
        UNION ALL
        (SELECT 'most_vendors', ge, pct, below FROM t_compliance ORDER BY below DESC, ge LIMIT 1)
        """,
    "email_payload": "SELECT DISTINCT "
    f"{_CELL}, {_V}, vname AS vendor_name, total AS sum_weighted_est_rev_eur, "
    + ", ".join(
        f"coalesce(gap{n}_product_name_local, gap{n}_product_name_en) AS product_{n}_name, "
        f"gap{n}_barcode AS product_{n}_barcode, gap{n}_image_url AS product_{n}_image"
        for n in (1, 2, 3)
    )
    + " FROM t_result WHERE uc1",
}

_NAME = re.compile(r"\bt_\w+")


def statement(final: str, blocks: dict[str, str] = BLOCKS) -> str:
    """``final`` preceded by the blocks it needs, each after its own."""
    needed: dict[str, str] = {}

    def pull(text: str) -> None:
        for name in _NAME.findall(text):
            if name not in needed and name in blocks:
                pull(blocks[name])
                needed[name] = blocks[name]

    pull(final)
    head = ",\n".join(f"{n} AS MATERIALIZED ({body})" for n, body in needed.items())
    # The statement itself becomes the last block, as it may open with a WITH of its own.
    return f"WITH {head}\nSELECT * FROM ({final})" if head else final


def oracle_sql() -> dict[str, str]:
    done = {name: statement(final) for name, final in STATEMENTS.items()}
    # This job leaves out one order vertical, so orders of unknown vertical go too.
    shops = BLOCKS | {"t_item": BLOCKS["t_item"] + " AND vt <> 'darkstores'"}
    done["gap_v2"] = statement(STATEMENTS["gap_v2"], shops)
    # Three windows: last month's vendors, the last 2,000 days' products, a named month's orders.
    rolling = BLOCKS | {
        "t_month": "SELECT * FROM t_vendor WHERE month = DATE '1999-11-01'",
        "t_active": BLOCKS["t_active"].replace(
            IN_WINDOW, "BETWEEN DATE '1999-12-15' - 1999 AND DATE '1999-12-15'"
        ),
        "t_item": BLOCKS["t_item"].replace(
            IN_WINDOW, "BETWEEN DATE '1997-05-01' AND DATE '1997-05-31'"
        ),
    }
    done["gap_v1"] = statement(STATEMENTS["gap_v1"], rolling)
    return done
