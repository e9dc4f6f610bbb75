"""DuckDB SQL equivalents of the registered queries.

Each query is derived from the relational test tables by its own route:
order totals are a window over the lines, an order's channel is looked up per
(source, company) pair, fee methods become numeric terms, and typed SKUs are
matched once each against one table of tiered keys.  None of it goes through
JSON documents, landing or the shuffle-free costing that it checks.
Decimal division is done exactly in integer
arithmetic because DuckDB divides decimals in DOUBLE; ``dq`` rounds the
true quotient HALF_UP once, the same as the Spark side.
"""

from __future__ import annotations

from ..operators import returns
from ..sources import seeds, testdata


def dq(a: str, b: str, s_in: int, s_out: int = 12) -> str:
    """Exact ``round_half_up(a / b, s_out)`` with both operands first rounded
    to ``s_in`` decimals; NULL when b is 0 or NULL."""
    A = f"CAST(CAST(({a}) AS DECIMAL(38,{s_in})) * {10 ** s_in} AS HUGEINT)"
    B = f"CAST(CAST(({b}) AS DECIMAL(38,{s_in})) * {10 ** s_in} AS HUGEINT)"
    N = f"({A} * CAST({10 ** s_out} AS HUGEINT))"
    unit = "0." + "0" * (s_out - 1) + "1"
    q = (f"({N} // {B} + CASE WHEN 2 * abs({N} % {B}) >= abs({B}) "
         f"THEN CAST(sign({N}) * sign({B}) AS HUGEINT) ELSE 0 END)")
    return (f"(CASE WHEN ({B}) IS NULL OR ({B}) = 0 THEN NULL "
            f"ELSE CAST({q} AS DECIMAL(25,0)) * CAST('{unit}' AS DECIMAL({s_out + 1},{s_out})) END)")


def money(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DECIMAL(18,2))"


def pct(x: str) -> str:
    return f"CAST(ROUND({x}, 4) AS DECIMAL(18,4))"


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, (int, float)):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


_SRC_CASE = "CASE o_orderkey % 13 " + " ".join(
    f"WHEN {i} THEN {v}" for i, v in enumerate(testdata.ORDER_SOURCE_BY_MOD13)) + " END"


def _pick_case(expr: str, values: list) -> str:
    parts = []
    for i, v in enumerate(values):
        lit = "NULL" if v is None else "'" + v.replace("'", "''") + "'"
        parts.append(f"WHEN {i} THEN {lit}")
    return f"CASE {expr} " + " ".join(parts) + " END"


D2 = "DECIMAL(18,2)"
D4 = "DECIMAL(18,4)"

# --- fixture tables, relational form -------------------------------------
BASE_CTES = f"""
o_src AS (
  SELECT o_orderkey AS order_id,
         'MK-' || CAST(o_orderkey AS VARCHAR) AS order_source_order_id,
         o_orderdate AS created_on,
         o_orderdate + INTERVAL 2 DAY AS last_updated,
         CAST(o_totalprice AS DECIMAL(14,2)) AS grand_total,
         {_SRC_CASE} AS order_source,
         CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 WHEN 'P' THEN 1 END AS status_code,
         CASE WHEN o_custkey % 3 = 0 THEN '195' ELSE '100' END AS company_id,
         CAST(o_orderkey % 15 AS {D4}) AS shipping_total,
         CASE WHEN o_orderkey % 11 <> 0
              THEN CAST(CAST(o_orderkey % 20 AS DECIMAL(12,2)) + CAST('0.99' AS DECIMAL(3,2)) AS {D4}) END
           AS final_shipping_fee
  FROM orders
),
li AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_quantity, l.l_extendedprice, l.l_discount,
         l.l_returnflag, l.l_linestatus, p.p_name, p.p_retailprice,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_partkey, l.l_suppkey,
                            l.l_linenumber, l.l_quantity, l.l_extendedprice) AS rn,
         CASE WHEN l.l_orderkey % 97 = 0 THEN CAST(0 AS {D2})
              ELSE CAST(ROUND(CAST(l.l_extendedprice AS {D2}) * (1 - CAST(l.l_discount AS {D2})), 2) AS {D2})
         END AS line_total
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
  WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders)
),
it AS (
  SELECT l_orderkey AS order_id,
         l_orderkey * 100 + rn AS order_item_id,
         'SKU-' || CAST(l_partkey AS VARCHAR) AS source_sku,
         CASE WHEN l_partkey % 5 = 4 THEN 'SKU-' || CAST(l_partkey - 4 AS VARCHAR) END AS parent_sku,
         COALESCE(CASE WHEN l_partkey % 5 = 4 THEN 'SKU-' || CAST(l_partkey - 4 AS VARCHAR) END,
                  'SKU-' || CAST(l_partkey AS VARCHAR)) AS sku,
         p_name AS product_name,
         CAST(CAST(l_quantity AS DECIMAL(12,2)) AS {D4}) AS qty,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS {D4}) AS qty_returned,
         CASE WHEN l_partkey % 10 <> 9 THEN CAST(CAST(p_retailprice AS {D2}) + 1500 AS {D4}) END AS unit_price,
         CAST(line_total AS {D4}) AS revenue,
         CASE WHEN l_partkey % 17 <> 0
              THEN CAST(ROUND(CAST(p_retailprice AS {D2}) * CAST('0.40' AS DECIMAL(3,2)), 2) AS {D4}) END AS unit_cost,
         CAST(ROUND(CAST(l_extendedprice AS {D2}) * CAST('0.12' AS DECIMAL(3,2)), 2) AS {D4}) AS marketplace_fee,
         CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_orderkey % 97 <> 0
                   THEN line_total ELSE 0 END AS {D4}) AS refunds,
         (l_partkey % 50 = 0) AS is_bundle
  FROM li
),
stg_items AS (
  SELECT order_id, order_item_id, source_sku, parent_sku, sku, product_name, qty, qty_returned,
         unit_price, revenue, unit_cost,
         CAST(CAST(qty AS DECIMAL(38,4)) * CAST(COALESCE(unit_cost, 0) AS DECIMAL(38,4)) AS DECIMAL(22,8)) AS cogs,
         marketplace_fee, refunds, is_bundle
  FROM it
),
channel_map AS ({_values(seeds.CHANNEL_MAP_ROWS, ['order_source', 'company_id', 'channel'])}),
channel_fee_rules AS (
  SELECT channel, fee_method, CAST(fee_pct AS DECIMAL(10,4)) AS fee_pct,
         CAST(flat_fee AS DECIMAL(12,2)) AS flat_fee, channel_pays_shipping
  FROM ({_values(seeds.FEE_RULES_ROWS, ['channel', 'fee_method', 'fee_pct', 'flat_fee', 'channel_pays_shipping'])}) s
),
cat_src AS (
  SELECT p_partkey, 'SKU-' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         CASE WHEN p_partkey % 5 = 4 THEN 'SKU-' || CAST(p_partkey - 4 AS VARCHAR) END AS shadow_of,
         p_retailprice, p_brand, p_type, p_size
  FROM part
  UNION ALL
  SELECT p_partkey, 'SKU.' || CAST(p_partkey AS VARCHAR), p_name || ' (twin)', NULL,
         p_retailprice, p_brand, p_type, p_size
  FROM part WHERE p_partkey % 100 = 0
),
stg_catalog AS (
  SELECT product_id AS sku,
         COALESCE(shadow_of, product_id) AS canonical_sku,
         shadow_of AS parent_sku,
         product_name,
         CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN 'Inactive' ELSE 'Active' END
           AS active_status,
         CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_partkey % 7 <> 0 END AS is_active,
         (p_partkey % 11 = 0) AS is_end_of_life,
         (p_partkey % 50 = 0) AS is_kit,
         CAST(CAST(p_retailprice AS {D2}) + 1500 AS {D4}) AS msrp,
         CAST(ROUND(CAST(p_retailprice AS {D2}) * CAST('0.40' AS DECIMAL(3,2)), 2) AS {D4}) AS average_cost,
         CASE WHEN p_partkey % 6 = 0 THEN CAST(0 AS {D4})
              ELSE CAST(ROUND(CAST(p_retailprice AS {D2}) * CAST('0.45' AS DECIMAL(3,2)), 2) AS {D4}) END
           AS last_cost,
         CASE WHEN p_partkey % 6 = 0
              THEN CAST(ROUND(CAST(p_retailprice AS {D2}) * CAST('0.40' AS DECIMAL(3,2)), 2) AS {D4})
              ELSE CAST(ROUND(CAST(p_retailprice AS {D2}) * CAST('0.45' AS DECIMAL(3,2)), 2) AS {D4}) END
           AS current_cost,
         p_brand AS brand, p_type AS product_type, CAST(p_size AS {D4}) AS weight_lbs
  FROM cat_src
)
"""


def stg_orders_cte(excluded: list[int]) -> str:
    where = f"WHERE status_code NOT IN ({', '.join(map(str, excluded))})" if excluded else ""
    return f"""
stg_orders AS (
  SELECT order_id, order_source, company_id, status_code, created_on, last_updated, grand_total,
         COALESCE(shipping_total, 0) AS shipping_charged_to_customer,
         COALESCE(final_shipping_fee, 0) AS order_shipping_cost,
         order_source_order_id, 'Company ' || company_id AS company_name,
         'store/orders/' || CAST(order_id AS VARCHAR) AS order_source_url
  FROM o_src {where}
)"""


# Costed lines: totals by window, channel per (source, company), fees as terms.
COSTED_CTES = f"""
pair_channel AS (
  SELECT order_source, company_id,
         COALESCE(MIN(channel) FILTER (WHERE exact), MIN(channel) FILTER (WHERE NOT exact), 'Other') AS channel
  FROM (SELECT p.order_source, p.company_id, s.channel, COALESCE(TRIM(s.company_id), '') <> '' AS exact
        FROM (SELECT DISTINCT order_source, company_id FROM stg_orders) p
        LEFT JOIN channel_map s ON s.order_source = p.order_source
             AND COALESCE(TRIM(s.company_id), '') IN ('', p.company_id)) c
  GROUP BY order_source, company_id
),
channel_terms AS (
  SELECT channel, fee_method, channel_pays_shipping,
         COALESCE(fee_pct, 0) AS fee_pct, COALESCE(flat_fee, 0) AS flat_fee,
         CAST(fee_method = 'from_actuals' AS TINYINT) AS of_actuals,
         CAST(fee_method = 'computed_pct_flat' AS TINYINT) AS of_computed,
         CAST(fee_method = 'wholesale_none' AS TINYINT) AS of_list_price
  FROM channel_fee_rules
),
line_share AS (
  SELECT *, COALESCE({dq('revenue', 'order_revenue', 4)}, 0) AS share
  FROM (SELECT *, CAST(SUM(revenue) OVER (PARTITION BY order_id) AS DECIMAL(22,4)) AS order_revenue
        FROM stg_items) t
),
costed AS (
  SELECT s.* EXCLUDE (share), o.created_on, o.order_source, o.company_id, pc.channel, o.order_shipping_cost,
         t.fee_method, t.fee_pct, t.flat_fee, t.channel_pays_shipping,
         CAST(CAST(COALESCE(o.order_shipping_cost, 0) AS DECIMAL(12,4)) * CAST(share AS DECIMAL(24,12))
              AS DECIMAL(26,12)) AS allocated_shipping_cost,
         CAST(CAST(COALESCE(t.flat_fee, 0) AS DECIMAL(12,4)) * CAST(share AS DECIMAL(24,12))
              AS DECIMAL(26,12)) AS allocated_flat_fee,
         CAST(COALESCE(of_actuals * CAST(marketplace_fee AS DECIMAL(26,12))
                       + of_computed * CAST(CAST(s.revenue AS DECIMAL(22,4)) * t.fee_pct + allocated_flat_fee
                                            AS DECIMAL(26,12)), 0) AS DECIMAL(26,12)) AS channel_fee,
         CAST(COALESCE(of_list_price * GREATEST(CAST(CAST(unit_price AS DECIMAL(19,4)) * qty AS DECIMAL(28,8))
                                                - s.revenue, 0), 0) AS DECIMAL(22,8)) AS list_discount,
         o.created_on AS ordered_at, CAST(o.created_on AS DATE) AS order_date,
         s.revenue - cogs AS gross_profit, s.revenue - refunds AS net_revenue,
         net_revenue - cogs - channel_fee - allocated_shipping_cost AS contribution
  FROM line_share s
  LEFT JOIN stg_orders o USING (order_id)
  LEFT JOIN pair_channel pc ON pc.order_source IS NOT DISTINCT FROM o.order_source
       AND pc.company_id IS NOT DISTINCT FROM o.company_id AND o.order_id IS NOT NULL
  LEFT JOIN channel_terms t ON t.channel = pc.channel
),
catalog_rollup AS (
  SELECT canonical_sku, MAX(msrp) AS msrp, MAX(current_cost) AS current_cost, BOOL_OR(is_active) AS is_active
  FROM stg_catalog GROUP BY canonical_sku
)
"""


def with_ctes(body: str, excluded: list[int] | None = None, extra: str = "") -> str:
    ctes = [BASE_CTES.strip(), stg_orders_cte(excluded or []).strip(), COSTED_CTES.strip()]
    if extra:
        ctes.append(extra.strip())
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- returns (relational form of the submissions) -----------------------------
_TYPED = ("CASE WHEN l_partkey % 100 = 0 THEN 'SKU ' || CAST(l_partkey AS VARCHAR) "
          "WHEN l_partkey % 5 = 0 THEN 'SKU-' || CAST(l_partkey AS VARCHAR) "
          "WHEN l_partkey % 5 = 1 THEN '  sku-' || CAST(l_partkey AS VARCHAR) || ' ' "
          "WHEN l_partkey % 5 = 2 THEN 'SKU' || CAST(l_partkey AS VARCHAR) "
          "WHEN l_partkey % 5 = 3 THEN 'OLD-' || CAST(l_partkey AS VARCHAR) "
          "ELSE 'ZZZ ' || CAST(l_partkey AS VARCHAR) END")

RETURNS_CTES = f"""
ret_lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, {_TYPED} AS typed
  FROM lineitem WHERE l_returnflag = 'R'
),
raw_returns AS (
  SELECT 'S' || CAST(r.l_orderkey AS VARCHAR) AS submission_id,
         o.o_orderdate + INTERVAL 20 DAY AS created_at,
         'RMA-' || CAST(r.l_orderkey AS VARCHAR) AS order_rma,
         string_agg(r.typed, ',' ORDER BY r.l_partkey, r.l_suppkey, r.l_linenumber, r.l_quantity,
                    r.l_extendedprice)
           || CASE WHEN r.l_orderkey % 6 = 0 THEN ', ' ELSE '' END AS sku_raw,
         {_pick_case('r.l_orderkey % 4', testdata.RETURN_CHANNELS)} AS channel,
         {_pick_case('r.l_orderkey % 3', testdata.RETURN_REASONS)} AS reason,
         {_pick_case('r.l_orderkey % 8', testdata.RETURN_DISPOSITIONS)} AS disposition,
         CAST(CAST(r.l_orderkey % 7 + 5 AS DECIMAL(12,2)) + CAST('0.50' AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS labor_cost,
         CAST(CASE WHEN r.l_orderkey % 9 = 0
                   THEN CAST(1000 + r.l_orderkey % 1000 AS DECIMAL(12,2)) + CAST('0.25' AS DECIMAL(3,2))
                   ELSE CAST(r.l_orderkey % 37 AS DECIMAL(12,2)) * CAST('1.25' AS DECIMAL(3,2)) + 3 END
              AS DECIMAL(12,2)) AS processing_cost,
         r.l_orderkey AS okey
  FROM ret_lines r JOIN orders o ON o.o_orderkey = r.l_orderkey
  GROUP BY r.l_orderkey, o.o_orderdate
),
category_prefix AS ({_values(returns.DISPOSITION_PREFIXES, ['prefix', 'category'])}),
category_of AS (
  SELECT d.disposition, arg_max(c.category, length(c.prefix)) AS category
  FROM (SELECT DISTINCT disposition FROM raw_returns) d
  JOIN category_prefix c ON starts_with(upper(d.disposition), c.prefix) GROUP BY d.disposition
),
typed_skus AS (
  SELECT * EXCLUDE (typed_list), unnest(typed_list) AS sku_entered, len(typed_list) AS skus_in_submission
  FROM (SELECT *, list_filter(list_transform(str_split(COALESCE(sku_raw, ''), ','), lambda x: trim(x)),
                              lambda x: x <> '') AS typed_list FROM raw_returns) t
),
returned AS (
  SELECT t.*, COALESCE(c.category, 'unknown') AS disposition_category,
         lower(sku_entered) AS key_exact, regexp_replace(lower(sku_entered), '[^a-z0-9]', '', 'g') AS key_fuzzy,
         CAST(ROUND({dq('COALESCE(processing_cost, 0)', 'skus_in_submission', 2)}, 2) AS DECIMAL(12,2)) AS cost_share
  FROM typed_skus t LEFT JOIN category_of c ON c.disposition = t.disposition
),
sku_universe AS (
  SELECT DISTINCT raw_sku, canonical_sku
  FROM (SELECT unnest([sku, canonical_sku]) AS raw_sku, canonical_sku FROM stg_catalog) u
  WHERE trim(raw_sku) <> ''
),
tiered_keys AS (
  SELECT tier, k, MIN(target) AS canonical_sku
  FROM (SELECT 1 AS tier, 'old-' || CAST(p_partkey AS VARCHAR) AS k, 'SKU-' || CAST(p_partkey AS VARCHAR) AS target
        FROM part WHERE p_partkey % 10 = 3
        UNION ALL
        SELECT 2, lower(trim(raw_sku)), canonical_sku FROM sku_universe
        UNION ALL
        SELECT 3, regexp_replace(lower(raw_sku), '[^a-z0-9]', '', 'g'), canonical_sku FROM sku_universe) u
  GROUP BY tier, k HAVING tier < 3 OR MIN(target) = MAX(target)
),
best_match AS (
  SELECT w.key_exact, MIN(t.tier) AS tier, arg_min(t.canonical_sku, t.tier) AS canonical_sku
  FROM (SELECT DISTINCT key_exact, key_fuzzy, unnest([1, 2, 3]) AS tier FROM returned) w
  JOIN tiered_keys t ON t.tier = w.tier AND t.k = CASE WHEN w.tier = 3 THEN w.key_fuzzy ELSE w.key_exact END
  GROUP BY w.key_exact
),
stg_returns AS (
  SELECT concat_ws('|', submission_id, key_exact) AS return_line_id, submission_id, created_at, order_rma,
         channel AS channel_reported, reason, disposition, disposition_category, sku_entered,
         key_exact AS sku_norm, COALESCE(canonical_sku, sku_entered) AS sku,
         COALESCE(['alias', 'exact', 'normalized'][tier], 'unmatched') AS sku_match_status,
         skus_in_submission, processing_cost AS submission_processing_cost, cost_share AS processing_cost,
         labor_cost, disposition_category = 'warranty' AS is_warranty,
         list_contains(['new', 'open_box'], disposition_category) AS resells_as_new,
         list_contains(['used', 'refurbished'], disposition_category) AS resells_as_sd,
         disposition_category = 'scrapped' AS is_scrapped
  FROM returned LEFT JOIN best_match USING (key_exact)
)
"""


def _avg_pos(c: str) -> str:
    return money(dq(f"SUM({c}) FILTER (WHERE {c} > 0)", f"COUNT(*) FILTER (WHERE {c} > 0)", 12))


MART_CTES = f"""
sku_agg AS (
  SELECT sku, MAX(product_name) AS product_name, BOOL_OR(is_bundle) AS has_bundle_lines,
         COUNT(*) AS sales, COUNT(DISTINCT order_id) AS orders,
         CAST(SUM(qty) AS DECIMAL(28,4)) AS units_sold,
         CAST(SUM(qty_returned) AS DECIMAL(28,4)) AS units_returned,
         {money('SUM(revenue)')} AS gross_revenue, {money('SUM(refunds)')} AS refunds,
         {money('SUM(net_revenue)')} AS net_revenue, {money('SUM(cogs)')} AS cogs,
         {money('SUM(channel_fee)')} AS channel_fees,
         {money(dq('SUM(channel_fee)', 'COUNT(*)', 12))} AS avg_channel_fee_per_sale,
         {_avg_pos('allocated_shipping_cost')} AS avg_shipping_cost,
         {money('SUM(allocated_shipping_cost)')} AS shipping_cost,
         {money('SUM(gross_profit)')} AS gross_profit, {money('SUM(contribution)')} AS contribution
  FROM costed GROUP BY sku
),
fct_sku_profit AS (
  SELECT a.*, c.msrp, c.is_active,
         {money(dq('a.contribution', 'a.units_sold', 4))} AS contribution_per_unit,
         {pct(dq('a.contribution', 'a.net_revenue', 2))} AS contribution_margin_pct,
         {pct(dq('a.contribution', 'a.gross_revenue', 2))} AS contribution_margin_pct_gross,
         CASE WHEN COALESCE(c.msrp, 0) = 0 OR a.units_sold = 0 THEN NULL
              ELSE {pct(dq('a.contribution', 'CAST(c.msrp AS DECIMAL(38,4)) * CAST(a.units_sold AS DECIMAL(38,4))', 8))}
         END AS contribution_margin_pct_msrp
  FROM sku_agg a LEFT JOIN catalog_rollup c ON c.canonical_sku = a.sku
),
window_sums AS (
  SELECT sku, CAST(SUM(qty) AS DECIMAL(28,4)) AS units, SUM(contribution) AS earned, SUM(cogs) AS cost,
         SUM(revenue) AS paid, SUM(channel_fee + allocated_shipping_cost) AS other
  FROM costed WHERE date_diff('day', order_date, DATE '{testdata.AS_OF}') <= 90 GROUP BY sku
),
fct_sku_cost_watch AS (
  SELECT sku, is_active, msrp, units AS units_sold_window,
         {money(dq('paid', 'units', 12))} AS avg_selling_price,
         {money(dq('cost', 'units', 12))} AS at_sale_unit_cost,
         {money('current_cost')} AS current_unit_cost,
         {money(dq('other', 'units', 12))} AS other_unit_costs,
         {money('earned')} AS contribution_window,
         {money(dq('earned', 'units', 12))} AS contribution_per_unit_actual,
         {money('current_unit_cost - at_sale_unit_cost')} AS unit_cost_change,
         {pct(dq('unit_cost_change', 'at_sale_unit_cost', 2))} AS cost_change_pct,
         {money('avg_selling_price - current_unit_cost - other_unit_costs')} AS contribution_per_unit_at_current_cost,
         {pct(dq('contribution_per_unit_at_current_cost', 'avg_selling_price', 2))} AS margin_pct_at_current_cost,
         contribution_per_unit_at_current_cost < 0 AS sells_at_a_loss_now,
         10 * current_unit_cost > 11 * at_sale_unit_cost AS cost_up_over_10pct
  FROM window_sums LEFT JOIN catalog_rollup ON canonical_sku = sku
),
fct_sku_channel AS (
  SELECT sku || '|' || channel AS sku_channel, sku, channel, MAX(fee_method) AS fee_method,
         COUNT(*) AS sales, COUNT(DISTINCT order_id) AS orders,
         CAST(SUM(qty) AS DECIMAL(28,4)) AS units_sold,
         {money('SUM(revenue)')} AS gross_revenue,
         {money('SUM(channel_fee)')} AS channel_fee_total,
         {money(dq('SUM(channel_fee)', 'COUNT(*)', 12))} AS avg_fee_per_sale,
         {pct(dq('SUM(channel_fee)', 'SUM(revenue)', 12))} AS avg_fee_pct,
         {_avg_pos('allocated_shipping_cost')} AS avg_shipping_cost,
         {money('SUM(list_discount)')} AS list_discount_total
  FROM costed GROUP BY sku, channel
)
"""


def _sel(cols: list[str], types: dict, ts: set, prefix: str = "") -> str:
    out = []
    for c in cols:
        e = f"{prefix}{c}"
        if c in ts:
            e = ts_text(e)
        elif c in types:
            e = f"CAST({e} AS {types[c].upper()})"
        out.append(f"{e} AS {c}")
    return ", ".join(out)


def oracle_sql() -> dict[str, str]:
    from ..operators.costing import INT_COSTED_COLUMNS
    from .queries import (COSTED_TYPES, EXCLUDED_CODES, RETURNS_SINCE, TS_COLUMNS,
                          UPSERT_BATCH_FROM, UPSERT_NEW_STATUS, UPSERT_SNAPSHOT_BEFORE)
    now = testdata.FIXTURE_NOW
    W = with_ctes
    full = RETURNS_CTES + "," + MART_CTES
    costed_sel = _sel(INT_COSTED_COLUMNS, COSTED_TYPES, TS_COLUMNS)
    q: dict[str, str] = {}

    q["land_orders"] = W(f"""
SELECT order_id, order_source_order_id, {ts_text('created_on')} AS created_on,
       {ts_text('last_updated')} AS last_updated, grand_total, order_source, status_code,
       '{now}' AS extracted_at
FROM o_src""")
    q["land_catalog"] = W("""
SELECT product_id, product_name, shadow_of,
       CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * CAST('0.40' AS DECIMAL(3,2)), 2) AS DECIMAL(14,4)) AS average_cost
FROM cat_src""")
    q["land_returns"] = W(f"""
SELECT submission_id, {ts_text('created_at')} AS created_at, order_rma, sku_raw, channel, reason,
       disposition, labor_cost, processing_cost
FROM raw_returns""", extra=RETURNS_CTES)
    q["orders_repull_window"] = W(f"""
SELECT order_id, {ts_text('created_on')} AS created_on, status_code, grand_total
FROM o_src
WHERE created_on >= CAST(DATE '{testdata.AS_OF}' - INTERVAL 30 DAY AS TIMESTAMP)
  AND created_on <= CAST(DATE '{testdata.AS_OF}' + INTERVAL 1 DAY AS TIMESTAMP) - INTERVAL 1 SECOND""")
    q["returns_since"] = W(f"""
SELECT submission_id, {ts_text('created_at')} AS created_at, order_rma
FROM raw_returns WHERE created_at > TIMESTAMP '{RETURNS_SINCE}'""", extra=RETURNS_CTES)
    q["upsert_orders"] = W(f"""
SELECT order_id,
       CASE WHEN created_on >= TIMESTAMP '{UPSERT_BATCH_FROM}' THEN {UPSERT_NEW_STATUS} ELSE status_code END AS status_code,
       grand_total, {ts_text('created_on')} AS created_on,
       CASE WHEN created_on >= TIMESTAMP '{UPSERT_BATCH_FROM}' THEN '2001-08-03 06:00:00' ELSE '{now}' END AS extracted_at
FROM o_src
WHERE created_on < TIMESTAMP '{UPSERT_SNAPSHOT_BEFORE}' OR created_on >= TIMESTAMP '{UPSERT_BATCH_FROM}'""")
    q["upsert_orders_partitioned"] = q["upsert_orders"]
    q["upsert_stream_orders"] = q["upsert_orders"]
    q["upsert_counts"] = W(f"""
SELECT 'orders' AS kind, '{now}' AS extracted_at, count(*) AS documents, CAST(0 AS BIGINT) AS rejected,
       CAST(0 AS BIGINT) AS skipped_without_key, CAST(0 AS BIGINT) AS outside_window, CAST(0 AS BIGINT) AS repeated,
       count(*) AS written, CAST(0 AS BIGINT) AS replaced, CAST(0 AS BIGINT) AS problems
FROM o_src WHERE created_on < TIMESTAMP '{UPSERT_SNAPSHOT_BEFORE}'
UNION ALL
SELECT 'orders', '2001-08-03 06:00:00', 2 * count(*), 0, 0, 0, count(*), count(*),
       count(*) FILTER (WHERE created_on < TIMESTAMP '{UPSERT_SNAPSHOT_BEFORE}'), 0
FROM o_src WHERE created_on >= TIMESTAMP '{UPSERT_BATCH_FROM}'
UNION ALL
SELECT 'catalog', '{now}', count(*), 0, count(*) FILTER (WHERE lost), 0, 0, count(*) FILTER (WHERE NOT lost), 0, 0
FROM (SELECT (2 * p_partkey + CASE WHEN product_id LIKE 'SKU.%' THEN 1 ELSE 0 END) % 5 = 0 AS lost FROM cat_src)
UNION ALL
SELECT 'returns', '{now}', count(*), count(*) FILTER (WHERE k = 0), 0,
       count(*) FILTER (WHERE k <> 0 AND old), 0, count(*) FILTER (WHERE k <> 0 AND NOT old), 0,
       count(*) FILTER (WHERE k = 1 AND NOT old)
FROM (SELECT CAST(substr(submission_id, 2) AS BIGINT) % 7 AS k,
             created_at <= TIMESTAMP '{RETURNS_SINCE}' AS old FROM raw_returns)""", extra=RETURNS_CTES)
    q["upsert_catalog"] = W("""
SELECT product_id,
       CASE WHEN p_partkey % 3 = 0 THEN product_name || ' v2' ELSE product_name END AS product_name,
       shadow_of,
       CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * CAST('0.40' AS DECIMAL(3,2)), 2) AS DECIMAL(14,4)) AS average_cost
FROM cat_src""")
    q["upsert_returns"] = W(f"""
SELECT submission_id, {ts_text('created_at')} AS created_at,
       CASE WHEN created_at > TIMESTAMP '{RETURNS_SINCE}' THEN 'Used - rechecked' ELSE disposition END AS disposition,
       processing_cost
FROM raw_returns""", extra=RETURNS_CTES)
    q["sync_state"] = W(f"""
SELECT 'orders' AS source, '{now}' AS last_run_at, '{now}' AS watermark,
       {ts_text('MAX(created_on)')} AS max_created_on
FROM o_src""")
    latest_events = """
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE user_id IS NOT NULL) e
WHERE rn = 1"""
    q["upsert_events_latest"] = latest_events
    q["upsert_stream_latest"] = latest_events

    q["coerce_num"] = """
SELECT l_orderkey, l_linenumber, sent, TRY_CAST(NULLIF(TRIM(translate(sent, ',$', '')), '') AS DECIMAL(18,4)) AS num
FROM (SELECT l_orderkey, l_linenumber, CASE (l_orderkey + l_linenumber) % 8
        WHEN 0 THEN '$1,' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') || '.25'
        WHEN 1 THEN ' -' || CAST(l_partkey AS VARCHAR) || '.5 ' WHEN 2 THEN '' WHEN 3 THEN 'n/a'
        WHEN 4 THEN '{"amount":' || CAST(l_partkey AS VARCHAR) || '}' WHEN 5 THEN '999999999999999999'
        WHEN 6 THEN CAST(l_partkey AS VARCHAR) END AS sent FROM lineitem) t"""
    q["coerce_ts"] = """
SELECT o_orderkey, sent, CASE WHEN o_orderkey % 6 < 3 THEN strftime(sent_at, '%Y-%m-%d %H:%M:%S') END AS ts
FROM (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS sent_at, CASE o_orderkey % 6
        WHEN 0 THEN strftime(sent_at, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(sent_at + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S+02:00')
        WHEN 2 THEN strftime(sent_at, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(sent_at, '%Y') WHEN 4 THEN 'yesterday' END AS sent
      FROM orders) t"""
    q["coerce_text"] = """
SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN p_name WHEN 1 THEN CAST(p_partkey AS VARCHAR) WHEN 2 THEN 'true'
         WHEN 3 THEN '{"hh":"' || p_size || '"}' WHEN 4 THEN '["' || p_brand || '",' || p_size || ']' WHEN 5 THEN '' END AS txt
FROM part"""

    stg_orders_sel = """
SELECT order_id, order_source, company_id, status_code, strftime(created_on, '%Y-%m-%d %H:%M:%S') AS created_on,
       strftime(last_updated, '%Y-%m-%d %H:%M:%S') AS last_updated, grand_total,
       CAST(shipping_charged_to_customer AS DECIMAL(18,4)) AS shipping_charged_to_customer,
       CAST(order_shipping_cost AS DECIMAL(18,4)) AS order_shipping_cost,
       order_source_order_id, company_name, order_source_url
FROM stg_orders"""
    q["stg_orders"] = W(stg_orders_sel)
    q["stg_orders_excluded"] = W(stg_orders_sel, excluded=EXCLUDED_CODES)
    q["stg_order_items"] = W("SELECT * FROM stg_items")
    q["stg_catalog"] = W("SELECT * FROM stg_catalog")

    q["int_order_items_costed"] = W(f"SELECT {costed_sel} FROM costed")
    q["int_order_items_costed_joined"] = W(f"SELECT {costed_sel} FROM costed")
    q["int_order_items_costed_excluded"] = W(f"SELECT {costed_sel} FROM costed", excluded=EXCLUDED_CODES)
    q["order_channel"] = W("SELECT order_id, order_source, company_id, channel "
                           "FROM stg_orders JOIN pair_channel USING (order_source, company_id)")
    q["order_revenue"] = W("SELECT DISTINCT order_id, order_revenue FROM line_share")
    q["shipping_allocation"] = W(f"""
SELECT order_id, MAX(CAST(order_shipping_cost AS DECIMAL(18,4))) AS order_shipping_cost, COUNT(*) AS lines,
       {money('SUM(allocated_shipping_cost)')} AS allocated_shipping_total
FROM costed GROUP BY order_id""")
    q["channel_fee"] = W(f"""
SELECT channel, fee_method, COUNT(*) AS lines, {money('SUM(channel_fee)')} AS channel_fee_total,
       {money('SUM(allocated_flat_fee)')} AS flat_fee_total,
       {money('SUM(list_discount)')} AS list_discount_total
FROM costed GROUP BY channel, fee_method""")

    q["fct_order_item_profit"] = W(f"""
SELECT order_item_id, order_id, order_date, {ts_text('ordered_at')} AS ordered_at, channel, sku,
       source_sku, parent_sku, product_name, is_bundle, qty, qty_returned, revenue,
       CAST(net_revenue AS DECIMAL(19,4)) AS net_revenue, cogs,
       CAST(channel_fee AS DECIMAL(26,12)) AS channel_fee, marketplace_fee AS marketplace_fee_captured,
       {money('allocated_shipping_cost')} AS allocated_shipping_cost,
       {money('list_discount')} AS list_discount, refunds,
       CAST(gross_profit AS DECIMAL(24,8)) AS gross_profit, {money('contribution')} AS contribution
FROM costed""")
    q["fct_sku_profit"] = W("SELECT * FROM fct_sku_profit", extra=MART_CTES)
    q["fct_sku_profit_excluded"] = W("SELECT * FROM fct_sku_profit", excluded=EXCLUDED_CODES,
                                     extra=MART_CTES)
    q["fct_sku_profit_monthly"] = W(f"""
SELECT sku || '|' || strftime(date_trunc('month', ordered_at), '%Y-%m') AS sku_month,
       CAST(date_trunc('month', ordered_at) AS DATE) AS month, sku,
       MAX(product_name) AS product_name, COUNT(*) AS sales, COUNT(DISTINCT order_id) AS orders,
       CAST(SUM(qty) AS DECIMAL(28,4)) AS units_sold,
       {money('SUM(revenue)')} AS gross_revenue, {money('SUM(net_revenue)')} AS net_revenue,
       {money('SUM(cogs)')} AS cogs, {money('SUM(channel_fee)')} AS channel_fees,
       {money('SUM(allocated_shipping_cost)')} AS shipping_cost,
       {money('SUM(gross_profit)')} AS gross_profit, {money('SUM(contribution)')} AS contribution,
       {pct(dq('SUM(contribution)', 'SUM(net_revenue)', 12))} AS contribution_margin_pct
FROM costed GROUP BY 1, 2, 3""")
    q["fct_sku_channel"] = W("SELECT * FROM fct_sku_channel", extra=MART_CTES)
    q["fct_sku_cost_watch"] = W("SELECT * FROM fct_sku_cost_watch", extra=MART_CTES)
    q["catalog_rollup"] = W("SELECT * FROM catalog_rollup")
    q["sku_weighted_fee"] = W(f"""
SELECT sku, CAST(SUM(sales) AS BIGINT) AS sales,
       CAST(SUM(channel_fee_total) AS DECIMAL(18,2)) AS channel_fee_total,
       {money(dq('SUM(channel_fee_total)', 'SUM(sales)', 2))} AS weighted_fee_per_sale
FROM fct_sku_channel GROUP BY sku""", extra=MART_CTES)
    q["orders_total"] = W("""
SELECT COUNT(*) AS orders, CAST(SUM(grand_total) AS DECIMAL(24,2)) AS grand_total_sum FROM o_src""")

    q["returns_exploded"] = W("""
SELECT submission_id, sku_entered, key_exact, key_fuzzy, skus_in_submission,
       cost_share AS processing_cost
FROM returned""", extra=RETURNS_CTES)
    q["returns_disposition"] = W("""
SELECT submission_id, disposition, COALESCE(category, 'unknown') AS disposition_category
FROM raw_returns LEFT JOIN category_of USING (disposition)""", extra=RETURNS_CTES)
    q["sku_universe"] = W("SELECT * FROM sku_universe", extra=RETURNS_CTES)
    q["sku_ref_exact"] = W("SELECT k, canonical_sku FROM tiered_keys WHERE tier = 2", extra=RETURNS_CTES)
    q["sku_ref_normalized"] = W("SELECT k, canonical_sku FROM tiered_keys WHERE tier = 3", extra=RETURNS_CTES)
    q["sku_aliases_ref"] = W("SELECT k, canonical_sku FROM tiered_keys WHERE tier = 1", extra=RETURNS_CTES)
    q["stg_returns"] = W(f"""
SELECT return_line_id, submission_id, {ts_text('created_at')} AS created_at, order_rma,
       channel_reported, reason, disposition, disposition_category, sku_entered, sku_norm, sku,
       sku_match_status, skus_in_submission, submission_processing_cost, processing_cost, labor_cost,
       is_warranty, resells_as_new, resells_as_sd, is_scrapped
FROM stg_returns""", extra=RETURNS_CTES)

    def nn(model, rel, col):
        return (f"SELECT 'not_null' AS \"check\", '{model}' AS model, '{col}' AS \"column\", "
                f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {rel}")

    def un(model, rel, col):
        return (f"SELECT 'unique' AS \"check\", '{model}' AS model, '{col}' AS \"column\", "
                f"CAST(COUNT(*) AS BIGINT) AS failures FROM (SELECT {col} FROM {rel} "
                f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1) d")

    raw_cat = "(SELECT product_id FROM cat_src) rc"
    raw_ret = "(SELECT submission_id FROM raw_returns) rr"
    raw_ord = "(SELECT order_id, 'x' AS raw FROM o_src) ro"
    parts = [
        nn("stg_orders", "stg_orders", "order_id"),
        un("stg_orders", "stg_orders", "order_id"),
        nn("stg_order_items", "stg_items", "order_item_id"),
        un("stg_order_items", "stg_items", "order_item_id"),
        nn("stg_returns", "stg_returns", "return_line_id"),
        un("stg_returns", "stg_returns", "return_line_id"),
        nn("stg_returns", "stg_returns", "sku"),
        nn("fct_sku_profit", "fct_sku_profit", "sku"),
        un("fct_sku_profit", "fct_sku_profit", "sku"),
        nn("fct_sku_cost_watch", "fct_sku_cost_watch", "sku"),
        un("fct_sku_cost_watch", "fct_sku_cost_watch", "sku"),
        nn("raw_orders", raw_ord, "order_id"),
        un("raw_orders", raw_ord, "order_id"),
        nn("raw_orders", raw_ord, "raw"),
        nn("raw_catalog", raw_cat, "product_id"),
        un("raw_catalog", raw_cat, "product_id"),
        nn("raw_returns", raw_ret, "submission_id"),
        un("raw_returns", raw_ret, "submission_id"),
    ]
    q["dq_checks"] = W("\nUNION ALL\n".join(parts), extra=full)
    dq_all = "(" + "\nUNION ALL\n".join(parts) + ")"
    q["dq_not_null"] = W(f"SELECT * FROM {dq_all} d WHERE \"check\" = 'not_null' "
                         "AND NOT starts_with(model, 'raw_')", extra=full)
    q["dq_unique"] = W(f"SELECT * FROM {dq_all} d WHERE \"check\" = 'unique' "
                       "AND NOT starts_with(model, 'raw_')", extra=full)
    q["dq_landed"] = W(f"SELECT * FROM {dq_all} d WHERE starts_with(model, 'raw_')", extra=full)
    # Line values present in the source that do not convert to a number.
    src_cols = {"ID": "order_item_id", "Qty": "l_quantity",
                "QtyReturned": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
                "SitePrice": "p_retailprice", "LineTotal": "line_total",
                "AverageCost": "p_retailprice", "FinalValueFee": "l_extendedprice",
                "TotalRefunded": "line_total"}
    mal = "\nUNION ALL\n".join(
        f"SELECT 'malformed_number' AS \"check\", 'stg_order_items' AS model, '{f}' AS \"column\", "
        f"CAST(COUNT(*) FILTER (WHERE v IS NOT NULL AND TRY_CAST(v AS DECIMAL(18,4)) IS NULL) AS BIGINT) "
        f"AS failures FROM (SELECT CAST({c} AS VARCHAR) AS v FROM li_ids) x"
        for f, c in src_cols.items())
    q["dq_malformed"] = W(mal, extra="li_ids AS (SELECT li.*, l_orderkey * 100 + rn AS order_item_id FROM li)")
    # Generated documents parse, and their numbers convert, as long as the keys are there.
    q["dq_rejected"] = "\nUNION ALL\n".join(
        f"SELECT '{check}' AS \"check\", '{model}' AS model, '{column}' AS \"column\", "
        f"COUNT(*) FILTER (WHERE {key} IS NULL) AS failures FROM {source}"
        for check, model, column, key, source in [
            ("rejected", "raw_orders", "raw", "o_orderkey", "orders"),
            ("rejected", "raw_catalog", "raw", "p_partkey", "part"),
            ("rejected", "raw_returns", "raw", "o_orderkey", "orders"),
            *[("malformed_number", "stg_orders", c, "o_orderkey", "orders")
              for c in ("GrandTotal", "ShippingTotal", "FinalShippingFee")],
            *[("malformed_number", "stg_catalog", c, "p_partkey", "part")
              for c in ("SitePrice", "LastCost", "WeightLbs")]])
    q["int_order_items_costed_dropped"] = W(
        f"SELECT {costed_sel} FROM costed WHERE order_id IN (SELECT order_id FROM stg_orders)",
        excluded=EXCLUDED_CODES)
    return q
