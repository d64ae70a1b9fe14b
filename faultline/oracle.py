"""DuckDB spelling of the fixture views, shared by every oracle query.

``PREFIX`` defines, as CTEs over the pre-registered test tables:

* ``device_readings`` / ``offers`` — the adapted source views (see ``sources.fixtures``);
* ``offers_f`` — offers plus every derived offer column (B1);
* ``labelled`` / ``split_rows`` / ``scored`` / ``scored2`` — G1 labels (horizon 3), G2 split
  (purge 1, sizes 0.3) and the deterministic scores.

Each oracle body is wrapped as ``PREFIX SELECT * REPLACE (round(x, 6) ...) FROM (body)`` so
floating columns compare at 6 decimals, like the Spark side (``round_doubles``).
"""

from __future__ import annotations

# np_div(n, d) in SQL: numpy float division without errors
def sql_div(n: str, d: str) -> str:
    return (f"(CASE WHEN ({d}) <> 0 THEN ({n}) / ({d}) "
            f"WHEN ({d}) = 0 AND ({n}) > 0 THEN 'inf'::DOUBLE "
            f"WHEN ({d}) = 0 AND ({n}) < 0 THEN '-inf'::DOUBLE END)")


def sql_div0(n: str, d: str) -> str:
    return f"coalesce({sql_div(n, d)}, 0.0::DOUBLE)"


def sql_corr(a: str, b: str) -> str:
    """Pairwise-complete Pearson, NULL for constant input (DuckDB gives NaN there)."""
    return (f"(CASE WHEN isnan(corr({a}, {b})) THEN NULL "
            f"ELSE greatest(-1.0, least(1.0, corr({a}, {b}))) END)")


_PRICE = sql_div0("SOLD_AMOUNT", "SOLD_QUANTITY")

PREFIX = f"""
WITH device_readings AS (
  SELECT 'D' || CAST(user_id AS VARCHAR) AS device, CAST(ts AS DATE) AS date,
         CAST(count(*) AS DOUBLE) AS attribute1,
         round(sum(value), 6) AS attribute2,
         round(avg(value), 6) AS attribute3,
         max(value) AS attribute4,
         CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE) AS attribute5,
         CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS DOUBLE) AS attribute6,
         min(CASE WHEN event_type = 'purchase' THEN value END) AS attribute7,
         CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS DOUBLE) AS attribute8,
         round(max(value) - min(value), 6) AS attribute9,
         max(CASE WHEN event_type = 'error' AND value >= 150 THEN 1 ELSE 0 END) AS failure
  FROM events GROUP BY 1, 2
),
offers AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
         l.l_extendedprice, l.l_shipdate,
         CAST(l.l_shipdate AS DATE) AS OFFER_START_DATE,
         l.l_shipdate + to_hours(CAST(l.l_orderkey % 24 AS INTEGER)) AS OFFER_START_DTTM,
         l.l_shipdate + to_hours(CAST(l.l_orderkey % 24 AS INTEGER))
                      + to_minutes(l.l_linenumber * 90) AS OFFER_FINISH_DTTM,
         p.p_type AS VERTICAL, p.p_brand AS DOM_DOMAIN_AGG1, p.p_name AS DOMAIN_ID,
         CASE WHEN l.l_linestatus = 'F' THEN 'FREE' ELSE 'PAID' END AS SHIPPING_PAYMENT_TYPE,
         l.l_returnflag AS OFFER_TYPE,
         CASE WHEN l.l_suppkey % 20 = 0 THEN 'A' END AS ORIGIN,
         CAST(2 * p.p_size AS DOUBLE) AS INVOLVED_STOCK,
         CASE WHEN l.l_returnflag = 'R' THEN 0.0::DOUBLE ELSE l.l_quantity END AS SOLD_QUANTITY,
         CASE WHEN l.l_returnflag = 'R' THEN NULL
              ELSE l.l_extendedprice * (1 - l.l_discount) END AS SOLD_AMOUNT,
         CAST(2 * p.p_size AS DOUBLE)
           - CASE WHEN l.l_returnflag = 'R' THEN 0.0::DOUBLE ELSE l.l_quantity END
           AS REMAINING_STOCK_AFTER_END
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
offers_b AS (
  SELECT *,
    date_diff('microsecond', OFFER_START_DTTM, OFFER_FINISH_DTTM) / 3.6e9 AS DURATION_HOURS,
    hour(OFFER_START_DTTM) AS START_HOUR,
    isodow(OFFER_START_DTTM) - 1 AS WEEKDAY,
    CASE WHEN isodow(OFFER_START_DTTM) - 1 IN (5, 6) THEN 1 ELSE 0 END AS WEEKEND,
    INVOLVED_STOCK - REMAINING_STOCK_AFTER_END AS STOCK_SOLD,
    {sql_div0("SOLD_QUANTITY", "INVOLVED_STOCK")} AS SALES_RATE,
    {_PRICE} AS PRICE_PER_UNIT,
    {sql_div0("SOLD_AMOUNT", "INVOLVED_STOCK")} AS VALUE_PER_STOCK_UNIT,
    CASE WHEN isnan({_PRICE} * INVOLVED_STOCK) THEN NULL ELSE {_PRICE} * INVOLVED_STOCK END
      AS POTENTIAL_VALUE
  FROM offers
),
offers_f AS (
  SELECT *,
    CASE WHEN DURATION_HOURS <= 2 THEN 'curta(≤2h)' WHEN DURATION_HOURS <= 6 THEN 'média(2–6h)'
         WHEN DURATION_HOURS IS NOT NULL THEN 'longa(>6h)' END AS DURATION_BUCKET,
    CASE WHEN START_HOUR >= 0 AND START_HOUR < 6 THEN 'madrugada'
         WHEN START_HOUR >= 6 AND START_HOUR < 12 THEN 'manha'
         WHEN START_HOUR >= 12 AND START_HOUR < 18 THEN 'tarde'
         WHEN START_HOUR IS NOT NULL THEN 'noite' END AS DAYPART,
    CASE WHEN SALES_RATE = 0 THEN 'Não_Vendida' WHEN SALES_RATE < 1.0 THEN 'Venda_Parcial'
         WHEN SALES_RATE IS NOT NULL THEN 'Esgotada' END AS PERFORMANCE_CATEGORY,
    {sql_div0("SOLD_AMOUNT", "POTENTIAL_VALUE")} AS SALES_EFFICIENCY,
    CASE WHEN STOCK_SOLD - INVOLVED_STOCK IS NOT NULL
         THEN greatest(STOCK_SOLD - INVOLVED_STOCK, 0.0) END AS OVERSELLING_MARGIN,
    INVOLVED_STOCK - REMAINING_STOCK_AFTER_END AS STOCK_SOLD_calc,
    abs(INVOLVED_STOCK - REMAINING_STOCK_AFTER_END - SOLD_QUANTITY) AS SOLD_UNITS_MISMATCH,
    CASE WHEN INVOLVED_STOCK > 0 THEN STOCK_SOLD / INVOLVED_STOCK END AS SELL_THROUGH,
    CASE WHEN REMAINING_STOCK_AFTER_END <= 0 THEN 1 ELSE 0 END AS STOCKOUT_FLAG,
    CASE WHEN REMAINING_STOCK_AFTER_END < 0 THEN 1 ELSE 0 END AS OVERSELL_FLAG,
    CASE WHEN REMAINING_STOCK_AFTER_END < 0 THEN -REMAINING_STOCK_AFTER_END ELSE 0.0 END
      AS OVERSELL_UNITS
  FROM offers_b
),
dr_scores AS (
  SELECT *,
    round(least(1.0, (0.5 * coalesce(avg(attribute4) OVER (PARTITION BY device ORDER BY date
                          ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.0)
                      + 0.5 * coalesce(lag(attribute4) OVER (PARTITION BY device ORDER BY date), 0.0))
                     / 300.0), 6) AS p1,
    round(least(1.0, (0.5 * coalesce(avg(attribute2) OVER (PARTITION BY device ORDER BY date
                          ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.0)
                      + 0.5 * coalesce(lag(attribute2) OVER (PARTITION BY device ORDER BY date), 0.0))
                     / 600.0), 6) AS p2,
    min(CASE WHEN failure = 1 THEN date END) OVER (PARTITION BY device ORDER BY date
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_fail,
    max(date) OVER (PARTITION BY device) AS last_date
  FROM device_readings
),
labelled AS (
  SELECT device, date, failure, p1, p2,
         CASE WHEN coalesce(date_diff('day', date, next_fail) <= 3, false) THEN 1 ELSE 0 END AS y
  FROM dr_scores
  WHERE coalesce(date_diff('day', date, next_fail) <= 3, false)
     OR (date <= last_date - INTERVAL 3 DAY AND coalesce(failure, 0) <> 1)
),
split_bounds AS (
  SELECT max(date) AS hi,
         CAST(max(date) - to_days(CAST(floor(date_diff('day', min(date), max(date)) * 0.3::DOUBLE) AS INTEGER)) AS DATE) AS test_cut,
         CAST(max(date) - to_days(2 * CAST(floor(date_diff('day', min(date), max(date)) * 0.3::DOUBLE) AS INTEGER)) AS DATE) AS val_cut
  FROM labelled
),
split_rows AS (
  SELECT l.*,
    CASE WHEN l.date <= b.val_cut - INTERVAL 1 DAY THEN 'train'
         WHEN l.date >= b.val_cut + INTERVAL 1 DAY AND l.date <= b.test_cut - INTERVAL 1 DAY THEN 'val'
         WHEN l.date >= b.test_cut + INTERVAL 1 DAY THEN 'test' END AS split
  FROM labelled l CROSS JOIN split_bounds b
),
scored AS (
  SELECT device, date, y, p1 AS p, split FROM split_rows WHERE split IS NOT NULL
),
scored2 AS (
  SELECT device, date, y, p1 AS p, split, 'm1' AS model FROM split_rows WHERE split IS NOT NULL
  UNION ALL
  SELECT device, date, y, p2 AS p, split, 'm2' AS model FROM split_rows WHERE split IS NOT NULL
)
"""


def wrap(body: str, float_cols: list[str], time_cols: list[str] | None = None,
         bigint_cols: list[str] | None = None) -> str:
    """Oracle text: shared prefix + body with floating columns rounded to 6 dp and
    dates/timestamps rendered as ISO text (the Spark side does the same)."""
    reps = [f'(round(CAST("{c}" AS DOUBLE) * 1e6) / 1e6 + 0.0) AS "{c}"' for c in float_cols]
    reps += [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in (time_cols or [])]
    # DuckDB sums integers into HUGEINT, which client libraries turn into floats
    reps += [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in (bigint_cols or [])]
    if reps:
        rep = ", ".join(reps)
        return f"{PREFIX}\nSELECT * REPLACE ({rep}) FROM (\n{body}\n) AS q"
    return f"{PREFIX}\nSELECT * FROM (\n{body}\n) AS q"
