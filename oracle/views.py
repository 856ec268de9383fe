"""DuckDB text of the six procure-to-pay views, as common table expressions."""

VIEWS = """
base AS (
  SELECT o_orderkey AS k, o_custkey AS cust,
         CAST(round(o_totalprice * 100) AS BIGINT) AS c,
         o_orderdate AS day, o_orderstatus <> 'P' AS approved,
         o_custkey % (SELECT count(*) FROM supplier) AS vendor_no,
         o_orderkey % 20 + 1 AS cc
  FROM orders
),
named AS (
  SELECT *,
    'VEND' || lpad(CAST(vendor_no AS VARCHAR), CAST(greatest(5, length(CAST(vendor_no AS VARCHAR))) AS INT), '0') AS vendor_id,
    'U' || lpad(CAST(cust AS VARCHAR), CAST(greatest(5, length(CAST(cust AS VARCHAR))) AS INT), '0') AS user_id,
    'CC' || lpad(CAST(cc AS VARCHAR), 3, '0') AS cost_centre
  FROM base
),
users AS (
  SELECT 'U' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(5, length(CAST(c_custkey AS VARCHAR))) AS INT), '0') AS user_id,
         c_name AS user_name, c_mktsegment AS role, 'DEPT' || (c_custkey % 10) AS department,
         CAST(c_custkey % 4 + 1 AS INT) AS access_level,
         TIMESTAMP '2001-08-01 00:00:00' + INTERVAL '1' DAY * CAST(c_custkey % 30 AS INT) AS last_login_date,
         c_custkey % 17 <> 0 AS is_active
  FROM customer
),
vendors AS (
  SELECT 'VEND' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(5, length(CAST(s_suppkey AS VARCHAR))) AS INT), '0') AS vendor_id,
         s_name AS vendor_name,
         CAST(DATE '1994-06-01' + INTERVAL '1' DAY * CAST(s_suppkey * 7 % 365 AS INT) AS DATE) AS vendor_creation_date,
         'CAT' || (s_nationkey % 10) AS vendor_category,
         'ACC' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS bank_account_number,
         'ADDR' || s_suppkey AS registered_address,
         'ap' || s_suppkey || '@vendor.example' AS contact_email,
         CASE WHEN s_suppkey % 2 = 0 THEN 'Transfer' ELSE 'Cheque' END AS payment_method,
         TRUE AS is_active,
         'U' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(5, length(CAST(s_suppkey AS VARCHAR))) AS INT), '0') AS created_by_user,
         FALSE AS is_ghost_vendor, 0 AS anomaly_flag
  FROM supplier
  UNION ALL
  SELECT 'GHOST' || g, 'Ghost Trading ' || g, DATE '2001-06-15', 'CAT' || (g % 10),
         'ACC9' || lpad(CAST(g AS VARCHAR), 8, '0'), NULL, 'g' || g || '@mail.example',
         'Transfer', TRUE, 'U' || lpad(CAST(g AS VARCHAR), 5, '0'), TRUE, 1
  FROM (SELECT DISTINCT o_orderkey % 15 AS g FROM orders WHERE o_orderkey % 269 = 7)
),
budget_cents AS (
  SELECT cc, cost_centre, year(day) AS yr, CAST(sum(c) AS BIGINT) AS approved
  FROM named GROUP BY ALL
),
budget_sized AS (
  SELECT *, CASE WHEN (cc * 7 + yr) % 5 = 0 THEN (cc * 13 + yr) % 300 + 1050
                 ELSE (cc * 31 + yr) % 700 + 300 END AS pm
  FROM budget_cents
),
budget AS (
  SELECT cost_centre, 'DEPT' || (cc % 10) AS department, CAST(yr AS VARCHAR) AS budget_period,
         CAST(approved AS DECIMAL(20,2)) * 0.01 AS approved_budget,
         CAST((approved * pm // 1000) * 1100 // 1000 AS DECIMAL(20,2)) * 0.01 AS committed_amount,
         CAST(approved * pm // 1000 AS DECIMAL(20,2)) * 0.01 AS actual_spend,
         CAST(approved - approved * pm // 1000 AS DECIMAL(20,2)) * 0.01 AS remaining_budget,
         CAST(pm AS DECIMAL(10,1)) * 0.1 AS budget_utilisation_pct,
         pm > 1000 AS is_overrun, CAST(pm > 1000 AS INT) AS anomaly_flag
  FROM budget_sized
),
purchase_orders AS (
  SELECT 'PO' || k AS po_number, day + INTERVAL '1' HOUR * CAST(k % 11 + 8 AS INT) AS po_date,
         vendor_id,
         'Supplier#' || lpad(CAST(vendor_no AS VARCHAR), CAST(greatest(9, length(CAST(vendor_no AS VARCHAR))) AS INT), '0') AS vendor_name,
         'ITEM' || (k % 50) AS item_description, CAST(k % 40 + 1 AS INT) AS quantity_ordered,
         CAST(c // (k % 40 + 1) AS DECIMAL(20,2)) * 0.01 AS unit_price,
         CAST(c AS DECIMAL(20,2)) * 0.01 AS total_po_value, c AS po_cents,
         'DEPT' || (cc % 10) AS department, cost_centre, 'B' || lpad(CAST(cc AS VARCHAR), 3, '0') AS budget_code,
         CASE WHEN approved THEN 'Approved' ELSE 'Pending' END AS approval_status,
         user_id AS approver_id, 'PLANT' || (k % 5) AS plant_location,
         approved AND c < 10000000 AND k % 37 = 5 AS is_split_po,
         CAST(approved AND c < 10000000 AND k % 37 = 5 AS INT) AS anomaly_flag
  FROM named
),
goods_receipts AS (
  SELECT 'GR' || k AS gr_number, day + INTERVAL '1' DAY * CAST(k % 28 + 3 AS INT) AS gr_date,
         'PO' || k AS po_number, vendor_id, CAST(k % 40 + 1 AS INT) AS quantity_received,
         CAST(c // (k % 40 + 1) AS DECIMAL(20,2)) * 0.01 AS actual_unit_price,
         'PLANT' || (k % 5) AS receiving_location, user_id AS received_by, 0 AS anomaly_flag
  FROM named WHERE approved AND k % 20 >= 3
),
timed AS (
  SELECT *, day + INTERVAL '1' DAY * CAST(k % 43 + 8 AS INT) AS landed,
         c * (970 + k % 61) // 1000 AS ic, CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END AS sgn
  FROM named
),
usual AS (
  SELECT *, CASE WHEN isodow(landed) >= 6 THEN landed + INTERVAL '1' DAY * CAST(8 - isodow(landed) AS INT) ELSE landed END
            + INTERVAL '1' HOUR * CAST(k % 11 + 8 AS INT) AS u
  FROM timed
),
inv_raw AS (
  SELECT 0 AS kind, k, u AS ts, 'V' || k AS ref, vendor_id, TRUE AS has_po, ic AS amount, * EXCLUDE (k, vendor_id)
    FROM usual WHERE approved AND k % 20 >= 3
  UNION ALL
  SELECT 1, k, u + INTERVAL '1' DAY * CAST(k % 25 + 1 AS INT), 'V' || k, vendor_id, TRUE, ic, * EXCLUDE (k, vendor_id)
    FROM usual WHERE approved AND k % 20 >= 3 AND k % 109 = 1
  UNION ALL
  SELECT 2, k, u + INTERVAL '1' DAY * CAST(k % 19 + 2 AS INT), 'VN' || k, vendor_id, TRUE,
         ic * (1000 + sgn * (5 + k % 15)) // 1000, * EXCLUDE (k, vendor_id)
    FROM usual WHERE approved AND k % 20 >= 3 AND k % 163 = 2
  UNION ALL
  SELECT 3, k, u, 'VM' || k, vendor_id, TRUE, c * (1000 + sgn * (60 + k % 290)) // 1000, * EXCLUDE (k, vendor_id)
    FROM usual WHERE approved AND k % 67 = 3
  UNION ALL
  SELECT 4, k, u, 'VK' || k, vendor_id, FALSE, ic, * EXCLUDE (k, vendor_id) FROM usual WHERE k % 89 = 4
  UNION ALL
  SELECT 5, k, day + INTERVAL '1' HOUR * CAST(19 + k % 5 AS INT), 'VA' || k, vendor_id, TRUE, ic, * EXCLUDE (k, vendor_id)
    FROM usual WHERE approved AND k % 131 = 5
  UNION ALL
  SELECT 6, k, u, 'VR' || k, vendor_id, FALSE, (1 + k % 50) * 1000000, * EXCLUDE (k, vendor_id) FROM usual WHERE k % 149 = 6
  UNION ALL
  SELECT 7, k, TIMESTAMP '2001-06-15 00:00:00' + INTERVAL '1' DAY * CAST(3 + k % 18 AS INT) + INTERVAL '1' HOUR * CAST(8 + k % 11 AS INT),
         'VG' || k, 'GHOST' || (k % 15), FALSE, 20000000 + (7919 * k) % 180000000, * EXCLUDE (k, vendor_id)
    FROM usual WHERE k % 269 = 7
),
inv_terms AS (
  SELECT *, CASE WHEN kind = 7 THEN 15 ELSE CASE k % 4 WHEN 0 THEN 30 WHEN 1 THEN 45 WHEN 2 THEN 60 ELSE 90 END END AS terms,
         CASE WHEN kind = 3 THEN 'Blocked' WHEN kind = 0 AND k % 20 = 19 THEN 'Open' ELSE 'Paid' END AS status,
         (CASE WHEN kind = 2 THEN ic ELSE amount END) * 180 // 1000 AS tax
  FROM inv_raw
),
invoices AS (
  SELECT 'INV' || kind || '-' || k AS invoice_number, ts AS invoice_date, ref AS vendor_invoice_number, vendor_id,
         CASE WHEN has_po THEN 'PO' || k END AS po_number,
         CASE WHEN has_po AND approved AND k % 20 >= 3 THEN 'GR' || k END AS gr_number,
         CAST(amount AS DECIMAL(20,2)) * 0.01 AS invoice_amount, amount AS cents,
         CAST(tax AS DECIMAL(20,2)) * 0.01 AS tax_amount, CAST(amount + tax AS DECIMAL(20,2)) * 0.01 AS total_amount,
         CAST(terms AS INT) AS payment_terms_days, ts + INTERVAL '1' DAY * CAST(terms AS INT) AS due_date,
         CASE WHEN status = 'Paid' THEN date_trunc('day', ts) + INTERVAL '1' DAY * CAST(terms + k % 16 - 5 AS INT)
              + INTERVAL '1' HOUR * CAST(k % 24 AS INT) END AS payment_date,
         CASE WHEN status = 'Paid' THEN CAST(amount + tax AS DECIMAL(20,2)) * 0.01 END AS payment_amount,
         status AS invoice_status, user_id AS processed_by,
         CASE WHEN status <> 'Blocked' THEN user_id END AS approved_by, cost_centre,
         kind = 1 AS is_duplicate, kind = 2 AS is_near_duplicate, kind = 3 AS is_match_failure, kind = 4 AS is_maverick,
         kind = 5 AS is_after_hours, kind = 6 AS is_round_number, kind = 7 AS is_ghost_vendor_inv,
         CAST(kind <> 0 AS INT) AS anomaly_flag,
         CASE kind WHEN 0 THEN 'Normal' WHEN 1 THEN 'Duplicate Invoice' WHEN 2 THEN 'Near-Duplicate Invoice'
              WHEN 3 THEN 'Three-Way Match Failure' WHEN 4 THEN 'Maverick Buying' WHEN 5 THEN 'After-Hours Transaction'
              WHEN 6 THEN 'Round Number' ELSE 'Ghost Vendor Invoice' END AS anomaly_type
  FROM inv_terms
)
"""


def q(body: str, *extra: str) -> str:
    """A query over the views; `extra` are further CTEs placed before `body`."""
    return "WITH " + ",\n".join([VIEWS, *extra]) + "\n" + body
