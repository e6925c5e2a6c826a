"""The same results in plain SQL, written independently of the operators."""

from __future__ import annotations

# Every column of a line, in the order the views use.
LINE = (
    "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
NET_ORDER = LINE.replace("l_quantity, ", "")

LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"

PHONE = "CASE o_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '09' || o_custkey END"
TIER = "CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Thành viên mặc định' ELSE 'Gold' END"


def customer_class(phone: str, tier: str) -> str:
    return f"""CASE WHEN coalesce({phone}, '') = '' AND coalesce({tier}, '') = '' THEN 'Khách lẻ'
      WHEN coalesce({phone}, '') <> '' AND coalesce({tier}, '') IN ('', 'Thành viên mặc định') THEN 'Khách mới'
      ELSE 'Khách quay lại' END"""


def calendar(d: str) -> str:
    return (
        f"CAST({d} AS DATE) AS date, strftime({d}, '%V-%G') AS week, strftime({d}, '%m-%Y') AS month, "
        f"CAST(year({d}) AS INTEGER) AS year"
    )


SALES = f"""SELECT {calendar('o_orderdate')}, 'S' || (o_custkey % 5) AS store, 'N' || l_orderkey AS number,
  CAST(o_orderkey % 4 + 1 AS INTEGER) AS guests, {customer_class(PHONE, TIER)} AS customer_class,
  'E' || l_suppkey AS employee, {PHONE} AS phone, p_name AS item, p_type AS category, l_quantity AS qty,
  l_extendedprice AS revenue, l_returnflag AS flag FROM {LINES}"""

CANCELLED = """SELECT date, week, month, year, employee, number, store, count(*) AS cancel_count, sum(qty) AS cancel_qty
  FROM sales WHERE flag = 'R' GROUP BY ALL"""

ORDERS = f"""sales AS ({SALES}), cancelled AS ({CANCELLED}), staff AS (
  SELECT s.date, s.week, s.month, s.year, s.store, s.number, guests, customer_class, s.employee, phone, revenue,
    coalesce(cancel_count, 0) AS cancel_count, coalesce(cancel_qty, 0) AS cancel_qty
  FROM (SELECT date, week, month, year, store, number, guests, customer_class, employee, phone, sum(revenue) AS revenue
        FROM sales WHERE phone IS NOT NULL GROUP BY ALL) s
  LEFT JOIN cancelled c ON s.date = c.date AND s.employee = c.employee AND s.number = c.number)"""

RATE = """rate AS (
  SELECT t.*, coalesce(known, 0) AS known, round_even(coalesce(known, 0) / orders * 100, 0) / 100 AS identified_rate
  FROM (SELECT date, week, month, year, store, employee, count(*) AS orders FROM staff GROUP BY ALL) t
  LEFT JOIN (SELECT date, employee, count(*) AS known FROM staff
             WHERE customer_class IN ('Khách hàng mới', 'Khách quay lại') GROUP BY ALL) k USING (date, employee))"""

DAILY = """SELECT 'N' || o_orderkey AS number, o_totalprice AS net, round(floor(o_totalprice) / 20, 2) AS discount,
  CAST(o_orderkey % 24 AS INTEGER) AS hour_in, CAST(o_custkey % 60 AS INTEGER) AS m_in,
  CAST((o_orderkey + o_custkey) % 25 AS INTEGER) AS hour_out, CAST((o_orderkey * 7) % 60 AS INTEGER) AS m_out,
  CAST(o_orderdate - CASE WHEN (o_orderkey + o_custkey) % 25 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS DATE) AS date,
  o_orderpriority, coalesce(r_name, 'Chi nhánh là') AS store
  FROM orders LEFT JOIN region ON o_custkey % 6 = r_regionkey"""

BILLS = """SELECT event_id, ts, user_id || '/' || strftime(ts, '%Y-%m-%d') AS number, value,
  CASE event_type WHEN 'view' THEN 'SALE_CHANGE' WHEN 'click' THEN 'SALE_MERGE_ORDER' WHEN 'signup' THEN 'SALE_SPLIT_ORDER'
    WHEN 'purchase' THEN '-' END AS log_type FROM events WHERE event_type <> 'error'"""

PAYLOAD = f"""SELECT l_orderkey, l_linenumber, 'E' || l_suppkey AS employee, 'B' || o_custkey AS id, p_name, p_brand, p_type,
  p_retailprice, l_quantity FROM {LINES} WHERE l_tax <> 0.08"""

SIGNED = f"""SELECT o_custkey AS id, p_type AS item,
  CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS qty, {NET_ORDER} FROM {LINES}"""

SQL: dict[str, str] = {}

SQL["daily_invoice_report"] = f"""WITH d AS ({DAILY})
SELECT month(date) || '-' || year(date) AS month_year, weekofyear(date) || '-' || isoyear(date) AS week_year,
  hour_in, hour_out, store, number, date, printf('%02d:%02d', hour_in, m_in) AS time_in,
  printf('%02d:%02d', hour_out, m_out) AS time_out, split_part(o_orderpriority, '-', 1) AS "table",
  substr(o_orderpriority, 3) AS area, round(net + discount, 2) AS gross, discount, net,
  CASE WHEN hour_out < 24 THEN round_even(((hour_out * 60 + m_out - hour_in * 60 - m_in + 1440) % 1440) / 60 * 100, 0) / 100
    END AS hours_used FROM d"""

SQL["invoices_per_store"] = f"SELECT store, count(*) AS invoices FROM ({DAILY}) GROUP BY store"

SQL["invoice_line_join"] = f"""WITH o AS (
  SELECT nullif(o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey END) AS id, o_orderkey % 5 AS store_uid,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 7 END AS "table", o_orderkey AS number, o_totalprice AS total FROM orders),
l AS (
  SELECT CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey END AS id, l_orderkey % 5 AS store_uid,
    CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey % 7 END AS "table", l_orderkey AS number,
    p_name || CASE WHEN p_brand = 'Brand#7' THEN ' Không lấy Topping' ELSE '' END AS item, l_quantity AS qty, {NET_ORDER}
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT o.id, o.store_uid, o."table", o.number, total, item, qty, l_linenumber, l_extendedprice,
  CASE WHEN item IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY o.number, item, qty
    ORDER BY {NET_ORDER.replace("l_orderkey, ", "")}) END AS mark
FROM o LEFT JOIN l ON o.id IS NOT DISTINCT FROM l.id AND o.store_uid IS NOT DISTINCT FROM l.store_uid
  AND o."table" IS NOT DISTINCT FROM l."table" AND o.number IS NOT DISTINCT FROM l.number
WHERE item IS NULL OR item NOT LIKE '%Không lấy Topping%'"""

SQL["customer_class"] = f"""SELECT o_orderkey, {PHONE} AS phone, {TIER} AS tier,
  {customer_class(PHONE, TIER)} AS customer_class FROM orders"""

SQL["calendar_labels"] = f"""SELECT o_orderkey, {calendar('o_orderdate')},
  weekofyear(o_orderdate) || '-' || isoyear(o_orderdate) AS week_short,
  month(o_orderdate) || '-' || year(o_orderdate) AS month_short,
  CAST(o_orderdate AS DATE) - CASE WHEN o_orderkey % 24 = 0 THEN 1 ELSE 0 END AS business_date FROM orders
UNION ALL SELECT event_id, {calendar('ts')}, weekofyear(ts) || '-' || isoyear(ts), month(ts) || '-' || year(ts),
  CAST(ts AS DATE) - CASE WHEN hour(ts) = 0 THEN 1 ELSE 0 END FROM events"""

SQL["time_parse"] = """SELECT event_id,
  CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:00') END AS parsed,
  strftime(ts, '%Y-%m-%d %H:%M:00') AS minute, strftime(ts, '%H:%M') AS clock,
  CASE WHEN event_id % 26 < 24 AND event_id % 61 < 60
    THEN strftime(ts, '%Y-%m-%d ') || printf('%02d:%02d:00', event_id % 26, event_id % 61) END AS closed FROM events"""

SQL["store_by_code"] = """WITH o AS (
  SELECT o_orderkey, o_custkey % 7 AS uid,
    ['CVGTN', 'CVGHX', 'TN', 'THU', 'CHV', 'RC', 'ZZ', 'xRC'][o_orderkey % 9 + 1] || o_orderkey AS number,
    CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN '0' ELSE 'Quán' END AS known FROM orders)
SELECT o_orderkey, number, coalesce(r_name, 'Chi nhánh là') AS store,
  CASE WHEN number LIKE '%CVGTN%' THEN 'Chạng Vạng Trần Não' WHEN number LIKE '%CVGHX%' THEN 'Chạng Vạng Hàng Xanh'
    WHEN number LIKE '%TN%' THEN 'Trăng Non' WHEN number LIKE '%THU%' THEN 'Thương' WHEN number LIKE '%CHV%' THEN 'Chênh Vênh'
    WHEN number IS NULL OR number LIKE '%RC%' THEN 'Ráng Chiều' ELSE 'Khác' END AS anywhere,
  CASE WHEN known = 'Quán' THEN known WHEN number LIKE 'THU%' THEN 'Thương'
    WHEN number LIKE 'CVGTN%' THEN 'Chạng Vạng Trần Não' WHEN number LIKE 'CVGHX%' THEN 'Chạng Vạng Hàng Xanh'
    WHEN number LIKE 'CHV%' THEN 'Chênh Vênh' WHEN number LIKE 'RC%' THEN 'Ráng Chiều' ELSE known END AS at_start
FROM o LEFT JOIN region ON uid = r_regionkey"""

SQL["table_area_split"] = """WITH o AS (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'A1' WHEN 2 THEN o_orderpriority || ' - x-y '
    ELSE o_orderpriority END AS t FROM orders)
SELECT o_orderkey, split_part(t, '-', 1) AS "table",
  CASE WHEN contains(t, '-') THEN trim(substr(t, instr(t, '-') + 1)) END AS area FROM o"""

SQL["payload_field"] = """SELECT event_id,
  CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
  CAST(NULL AS VARCHAR) AS missing, CAST(json_extract_string(props, '$.k') AS INTEGER) AS literal_k,
  CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS number,
  CAST(CASE WHEN event_type = 'view' THEN 0 ELSE trunc(value) END AS INTEGER) AS whole FROM events"""

SQL["nested_flatten"] = f"""WITH p AS ({PAYLOAD}), f AS (
  SELECT l_orderkey, l_linenumber, employee, id, 0 AS line_no, 'MAIN' AS kind, p_name AS item,
    CAST(NULL AS VARCHAR) AS parent_item, p_retailprice AS price, l_quantity AS qty FROM p
  UNION ALL SELECT l_orderkey, l_linenumber, employee, id, 1, 'TOPPING', p_brand, p_name, 5.0, l_quantity FROM p
    WHERE l_linenumber % 2 = 0
  UNION ALL SELECT l_orderkey, l_linenumber, employee, id, 2, 'TOPPING', p_type, p_name, 4.0, 1.0 FROM p
    WHERE l_linenumber % 2 = 0)
SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(qty AS DOUBLE) AS qty), 'cup' AS unit,
  round(price * qty, 2) AS revenue FROM f"""

SQL["cancellations"] = f"""WITH c AS (
  SELECT l_shipdate, CASE WHEN l_orderkey % 11 <> 0 THEN 'THU' || l_orderkey END AS number, 'E' || l_suppkey AS employee,
    p_name, p_type, l_quantity FROM {LINES} WHERE l_returnflag = 'R' AND l_tax <> 0.08)
SELECT {calendar('l_shipdate')}, CASE WHEN number IS NULL THEN 'Ráng Chiều' ELSE 'Thương' END AS store, number, employee,
  p_name AS item, l_quantity AS qty, p_type AS reason FROM c"""

SQL["cancelled_per_bill"] = f"WITH sales AS ({SALES}) {CANCELLED}"

_NOTE = """CASE o_orderkey % 8 WHEN 0 THEN NULL
  WHEN 1 THEN '[Gộp đơn] hóa đơn bị hủy bởi vì gộp vào HD' || o_orderkey || ' - bàn'
  WHEN 2 THEN 'hóa đơn bị hủy bởi vì gộp vào  HD' || o_orderkey || '/x'
  WHEN 3 THEN '[tách đơn] Các món được tách và tạo thành hóa đơn HD' || o_orderkey || ' b - bàn'
  WHEN 4 THEN '[Tách đơn] các món được tách và tạo thành hóa đơn HD' || o_orderkey
  WHEN 5 THEN 'các món được tách và tạo thành hóa đơn HD' || o_orderkey || ' - bàn'
  WHEN 6 THEN '[Tách đơn] HÓA ĐƠN ĐƯỢC TẠO MỚI'
  ELSE '[Tách đơn] các món được tách và tạo thành hóa đơn    - bàn' END"""


def _id_after(phrase: str) -> str:
    return (
        f"nullif(trim(coalesce(nullif(regexp_extract(note, '{phrase}\\s+(.+?)\\s+-', 1), ''), "
        f"nullif(regexp_extract(note, '{phrase}\\s+([A-Z0-9]+)', 1), ''))), '')"
    )


SQL["note_extract"] = f"""WITH n AS (SELECT o_orderkey, {_NOTE} AS note FROM orders), e AS (
  SELECT *, {_id_after('hóa đơn bị hủy bởi vì gộp vào')} AS merged_into,
    CASE WHEN lower(note) LIKE '%[tách đơn]%' AND lower(note) LIKE '%các món được tách và tạo thành hóa đơn%'
      THEN {_id_after('tạo thành hóa đơn')} END AS split_into FROM n)
SELECT o_orderkey, merged_into, split_into, coalesce(contains(note, '[Gộp đơn]'), false) AS is_merge,
  coalesce(contains(lower(note), 'hóa đơn được tạo mới'), false) AS is_new,
  coalesce(right(split_into, 4), 'None') AS suffix, CASE WHEN o_orderkey % 3 = 2 THEN 'tea' END AS clean FROM e"""

SQL["latest_snapshot"] = """SELECT '2024-01-15' AS asked, event_id, CAST(ts AS DATE) AS day, value FROM events
  WHERE CAST(ts AS DATE) = DATE '2024-01-15'
UNION ALL SELECT '2031-01-01', event_id, CAST(ts AS DATE), value FROM events
  WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"""

SQL["business_day_filter"] = """SELECT event_id, CAST(ts - INTERVAL 2 HOUR AS DATE) AS business_day FROM events"""

SQL["page_ingest"] = """SELECT event_id, CAST(user_id AS VARCHAR) AS tran_id, event_type AS log_type, props AS change_data,
  strftime(ts, '%Y-%m-%d %H:%M') AS created,
  (date_diff('day', DATE '2020-01-01', DATE '2024-02-01') * 131072 + event_id // 20 * 2) * 4294967296
    + event_id % 20 AS seq FROM events"""

_STORE_PAGES = """WITH e AS (
  SELECT *, strftime(ts, '%Y-%m-%d') AS _date, 's' || (user_id % 3) AS _store_uid,
    row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id % 3 ORDER BY event_id) - 1 AS place,
    count(*) OVER (PARTITION BY CAST(ts AS DATE), user_id % 3) AS total FROM events),
p AS (SELECT *, place // 40 + 1 AS page FROM e WHERE NOT (day(ts) % 5 = 0 AND place // 40 = 1))"""

SQL["page_records"] = f"""{_STORE_PAGES}
SELECT _date, _store_uid, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created, value AS total_amount,
  CAST(hour(ts) AS INTEGER) AS start_hour,
  (date_diff('day', DATE '2020-01-01', CAST(ts AS DATE)) * 131072 + page) * 4294967296 + place % 40 AS seq FROM p"""

SQL["page_manifest"] = f"""{_STORE_PAGES}, c AS (
  SELECT _date, _store_uid, count(DISTINCT page) AS pages, count(*) AS landed,
    max(CASE WHEN _store_uid <> 's2' THEN total END) AS announced, max(page) - count(DISTINCT page) AS missing FROM p GROUP BY ALL)
SELECT *, 0::BIGINT AS open_end, 0::BIGINT AS repeats, missing = 0 AND (announced IS NULL OR landed >= announced) AS complete FROM c"""

SQL["change_only_orders"] = f"""WITH b AS ({BILLS}) SELECT event_id, number, log_type FROM b
WHERE NOT EXISTS (SELECT 1 FROM b x WHERE x.number = b.number AND x.log_type <> 'SALE_CHANGE')"""

SQL["merge_split_semi"] = f"""WITH b AS ({BILLS}) SELECT event_id, number, 'any' AS part FROM b
WHERE EXISTS (SELECT 1 FROM b x WHERE x.number = b.number AND x.log_type IN ('SALE_MERGE_ORDER', 'SALE_SPLIT_ORDER'))
UNION ALL SELECT event_id, number, 'split' FROM b
WHERE EXISTS (SELECT 1 FROM b x WHERE x.number = b.number AND x.log_type = 'SALE_SPLIT_ORDER')"""

SQL["merge_chain"] = """WITH RECURSIVE n AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey > 0 THEN o_orderkey - 1 END AS up FROM orders),
w AS (SELECT id, id AS cur FROM n UNION ALL SELECT w.id, n.up FROM w JOIN n ON w.cur = n.id WHERE n.up IS NOT NULL)
SELECT id, min(cur) AS "end", 'N' || min(cur) AS number FROM w GROUP BY id"""

SQL["split_root"] = """WITH RECURSIVE n AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'F' AND o_orderkey > 0 THEN o_orderkey // 2 END AS up FROM orders),
w AS (SELECT id, id AS cur FROM n UNION ALL SELECT w.id, n.up FROM w JOIN n ON w.cur = n.id WHERE n.up IS NOT NULL),
r AS (SELECT id, min(cur) AS root FROM w GROUP BY id)
SELECT r.id, root, 'N' || first_value(r.id) OVER (PARTITION BY root ORDER BY o_orderdate DESC, r.id DESC) AS last_of_family
FROM r JOIN orders ON r.id = o_orderkey"""

SQL["merge_cycles"] = """SELECT o_orderkey AS id, o_orderkey // 3 * 3 AS smallest FROM orders"""

SQL["fill_both_ways"] = """WITH e AS (
  SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS bought,
    CASE WHEN value > 40 THEN event_type END AS large FROM events)
SELECT event_id, coalesce(last_value(bought IGNORE NULLS) OVER up, first_value(bought IGNORE NULLS) OVER down) AS bought,
  coalesce(last_value(large IGNORE NULLS) OVER up, first_value(large IGNORE NULLS) OVER down) AS large,
  first_value(bought IGNORE NULLS) OVER down AS next_bought FROM e
WINDOW up AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  down AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""

SQL["lifo_netting"] = f"""WITH s AS ({SIGNED}), w AS (
  SELECT *, sum(greatest(-qty, 0)) OVER (PARTITION BY id, item) AS owed,
    coalesce(sum(greatest(qty, 0)) OVER (PARTITION BY id, item ORDER BY {NET_ORDER}
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later FROM s)
SELECT id, item, qty - least(qty, greatest(0, owed - later)) AS qty, l_orderkey, l_linenumber, l_extendedprice FROM w
WHERE qty > 0 AND qty - least(qty, greatest(0, owed - later)) > 0"""

SQL["occurrence_join"] = f"""WITH s AS (SELECT * REPLACE (abs(qty) AS qty) FROM ({SIGNED})),
log AS (SELECT *, row_number() OVER (PARTITION BY id, item, qty ORDER BY {NET_ORDER}) AS mark FROM s WHERE l_linestatus = 'O'),
billed AS (SELECT id, item, qty, 'N' || l_orderkey AS number, l_extendedprice AS total, l_shipdate, l_partkey, l_suppkey,
  row_number() OVER (PARTITION BY id, item, qty ORDER BY {NET_ORDER}) AS mark FROM s WHERE l_returnflag <> 'R'),
j AS (SELECT log.*, b.number, b.total FROM log LEFT JOIN billed b
  ON log.id = b.id AND log.item = b.item AND log.qty = b.qty AND log.mark = b.mark),
facts AS (SELECT id, arg_min(number, (l_shipdate, number, l_partkey, l_suppkey, total)) AS number, max(total) AS total
  FROM billed GROUP BY id)
SELECT j.id, item, qty, mark, l_orderkey, l_linenumber, l_extendedprice,
  coalesce(last_value(j.number IGNORE NULLS) OVER up, first_value(j.number IGNORE NULLS) OVER down, facts.number) AS number,
  coalesce(last_value(j.total IGNORE NULLS) OVER up, first_value(j.total IGNORE NULLS) OVER down, facts.total) AS total
FROM j LEFT JOIN facts ON j.id = facts.id
WINDOW up AS (PARTITION BY j.id, item ORDER BY {NET_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  down AS (PARTITION BY j.id, item ORDER BY {NET_ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""

SQL["first_per_invoice"] = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE}) = 1"""

# Heights of the stock by recursion over the moves of a (root, item); then every ordered
# line is compared with all later moves of its item.
SQL["split_replay"] = f"""WITH RECURSIVE src AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {LINE}) AS n FROM {LINES}),
log AS (
  SELECT 'F' || o_custkey AS root, l_shipdate AS time, p_type AS item, l_extendedprice AS price,
    o_custkey * 1000000000 + n AS seq, l_returnflag = 'A' AND l_linestatus = 'O' AS is_split,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'C' || (o_orderkey % 2) || '_' || o_custkey
      ELSE 'F' || o_custkey END AS id,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'C' || (o_orderkey % 2) || '_' || o_custkey END AS child,
    CASE WHEN l_returnflag = 'R' THEN -l_quantity / 4 WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN l_quantity / 2
      ELSE l_quantity END AS qty FROM src),
main AS (SELECT root, coalesce(min(CASE WHEN id = root THEN id END), arg_min(id, (time, seq))) AS main FROM log GROUP BY root),
fam AS (SELECT log.*, NOT is_split AND id = main AS own FROM log JOIN main USING (root)),
ev AS (SELECT root, time, child, min(seq) AS pos FROM fam WHERE is_split GROUP BY ALL),
stay AS (SELECT root, time, child, item, abs(sum(qty)) AS q FROM fam WHERE is_split GROUP BY ALL),
moves AS (
  SELECT root, item, time, seq AS pos, CASE WHEN qty > 0 THEN 'push' ELSE 'void' END AS op, abs(qty) AS q,
    CAST(NULL AS VARCHAR) AS child FROM fam WHERE own
  UNION ALL SELECT i.root, i.item, ev.time, ev.pos, 'stay', coalesce(stay.q, 0), ev.child
  FROM (SELECT DISTINCT root, item FROM fam WHERE own) i JOIN ev ON i.root = ev.root
    LEFT JOIN stay ON stay.root = ev.root AND stay.time = ev.time AND stay.child = ev.child AND stay.item = i.item),
ord AS (SELECT *, row_number() OVER (PARTITION BY root, item ORDER BY time, pos) AS k FROM moves),
h AS (
  SELECT root, item, k, op, pos, child, CAST(0 AS DOUBLE) AS lo,
    CASE WHEN op = 'push' THEN q ELSE CAST(0 AS DOUBLE) END AS hi FROM ord WHERE k = 1
  UNION ALL SELECT o.root, o.item, o.k, o.op, o.pos, o.child, h.hi,
    CASE o.op WHEN 'push' THEN h.hi + o.q WHEN 'void' THEN greatest(0, h.hi - o.q) ELSE least(h.hi, o.q) END
  FROM h JOIN ord o ON o.root = h.root AND o.item = h.item AND o.k = h.k + 1),
pairs AS (
  SELECT p.root, p.item, p.pos AS seq, p.lo, p.hi, u.op, u.child,  u.k,
    min(u.hi) OVER (PARTITION BY p.pos ORDER BY u.k) AS m
  FROM h p JOIN h u ON u.root = p.root AND u.item = p.item AND u.k > p.k WHERE p.op = 'push'),
cut AS (SELECT *, greatest(0, least(hi, coalesce(lag(m) OVER (PARTITION BY seq ORDER BY k), hi)) - greatest(lo, m)) AS q FROM pairs),
rest AS (SELECT p.root, p.item, p.pos AS seq, greatest(0, least(p.hi, coalesce(min(m), p.hi)) - p.lo) AS q
  FROM h p LEFT JOIN pairs ON pairs.seq = p.pos WHERE p.op = 'push' GROUP BY p.root, p.item, p.pos, p.hi, p.lo),
parts AS (
  SELECT root, child AS id, item, q AS qty, seq, 0 AS at_end FROM cut WHERE op = 'stay' AND q > 0
  UNION ALL SELECT root, main, item, q, seq, 1 FROM rest JOIN main USING (root) WHERE q > 0
  UNION ALL SELECT root, id, item, qty, seq, 0 FROM fam WHERE NOT is_split AND NOT own)
SELECT parts.root, parts.id, 'no-' || parts.id AS number, parts.item, parts.qty, seq, price, at_end
FROM parts JOIN log USING (seq)"""

# What merges and splits do to this log can be said per customer k: bills of k % 4 = 1 with a
# merge row move to bill k + 1, and an even k has a child bill. Then as in split_replay.
_PLACE = "time, suffix, number, source_no"
_LAST = "time, branch, root, at_end, e_time, e_suffix, e_number, e_source, e_seq, number, source_no, seq"
SQL["order_reconstruction"] = f"""WITH RECURSIVE src AS (
  SELECT *, o_custkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY {LINE}) AS n,
    l_returnflag = 'A' AND l_linestatus = 'O' AND o_custkey % 2 = 0 AS is_split,
    l_returnflag = 'A' AND l_linestatus = 'O' AND o_custkey % 4 = 1 AS is_merge,
    l_returnflag = 'R' AND l_linestatus = 'O' AND o_custkey % 2 = 0 AND l_linenumber = 1 AS is_new FROM {LINES}),
ids AS (
  SELECT *, CASE WHEN is_new OR (l_returnflag = 'A' AND l_linestatus = 'F' AND k % 2 = 0) THEN 'C' || k ELSE 'B' || k END AS id0,
    CASE WHEN l_returnflag = 'R' AND NOT is_new THEN -l_quantity / 4 ELSE l_quantity END AS qty FROM src),
log AS (SELECT k, k * 1000000000 + n AS seq, l_shipdate AS time, p_type AS item, p_retailprice AS price,
  'E' || l_suppkey AS employee, is_split, is_merge, is_new, id0, 'no-' || id0 AS source_no, qty FROM ids),
touched AS (SELECT DISTINCT source_no FROM log WHERE is_split OR is_merge OR is_new),
plain AS (SELECT * FROM log WHERE source_no NOT IN (FROM touched)),
g AS (SELECT * FROM log WHERE source_no IN (FROM touched) AND NOT is_merge),
moved AS (SELECT *, CASE WHEN k % 4 = 1 THEN 'B' || (k + 1) ELSE id0 END AS id,
  CASE WHEN k % 4 = 1 AND 'B' || (k + 1) IN (SELECT id0 FROM g) THEN 'no-B' || (k + 1) ELSE source_no END AS number FROM g),
t AS (SELECT * FROM moved WHERE number IN (SELECT number FROM moved WHERE is_split OR is_new)),
parent AS (SELECT DISTINCT k FROM t WHERE is_split),
child AS (SELECT DISTINCT k FROM t WHERE id LIKE 'C%'),
fam0 AS (SELECT t.*, CASE WHEN id LIKE 'C%' AND t.k IN (FROM parent) THEN 'B' || t.k ELSE id END AS root,
  CASE WHEN is_split THEN 'C' || t.k END AS child, coalesce(right(CASE WHEN is_split THEN 'C' || t.k END, 4), 'None') AS suffix
  FROM t WHERE NOT is_new AND NOT (is_split AND t.k NOT IN (FROM child))),
main AS (SELECT root, coalesce(min(CASE WHEN id = root THEN id END), arg_min(id, ({_PLACE}, seq))) AS main FROM fam0 GROUP BY root),
fam AS (SELECT fam0.*, NOT is_split AND id = main AS own FROM fam0 JOIN main USING (root)),
ev AS (SELECT root, time, child, suffix, number, source_no, min(seq) AS pos FROM fam WHERE is_split GROUP BY ALL),
stay AS (SELECT root, time, child, item, abs(sum(qty)) AS q FROM fam WHERE is_split GROUP BY ALL),
moves AS (
  SELECT root, item, {_PLACE}, seq AS pos, CASE WHEN qty > 0 THEN 'push' ELSE 'void' END AS op, abs(qty) AS q,
    CAST(NULL AS VARCHAR) AS child FROM fam WHERE own
  UNION ALL SELECT i.root, i.item, ev.time, ev.suffix, ev.number, ev.source_no, ev.pos, 'stay', coalesce(stay.q, 0), ev.child
  FROM (SELECT DISTINCT root, item FROM fam WHERE own) i JOIN ev ON i.root = ev.root
    LEFT JOIN stay ON stay.root = ev.root AND stay.time = ev.time AND stay.child = ev.child AND stay.item = i.item),
ord AS (SELECT *, row_number() OVER (PARTITION BY root, item ORDER BY {_PLACE}, pos) AS k FROM moves),
h AS (
  SELECT root, item, k, op, pos, child, CAST(0 AS DOUBLE) AS lo,
    CASE WHEN op = 'push' THEN q ELSE CAST(0 AS DOUBLE) END AS hi FROM ord WHERE k = 1
  UNION ALL SELECT o.root, o.item, o.k, o.op, o.pos, o.child, h.hi,
    CASE o.op WHEN 'push' THEN h.hi + o.q WHEN 'void' THEN greatest(0, h.hi - o.q) ELSE least(h.hi, o.q) END
  FROM h JOIN ord o ON o.root = h.root AND o.item = h.item AND o.k = h.k + 1),
pairs AS (
  SELECT p.root, p.pos AS seq, p.lo, p.hi, u.op, u.child, u.pos, u.k, min(u.hi) OVER (PARTITION BY p.pos ORDER BY u.k) AS m
  FROM h p JOIN h u ON u.root = p.root AND u.item = p.item AND u.k > p.k WHERE p.op = 'push'),
cut AS (SELECT *, greatest(0, least(hi, coalesce(lag(m) OVER (PARTITION BY seq ORDER BY k), hi)) - greatest(lo, m)) AS q FROM pairs),
rest AS (SELECT p.root, p.pos AS seq, greatest(0, least(p.hi, coalesce(min(m), p.hi)) - p.lo) AS q
  FROM h p LEFT JOIN pairs ON pairs.seq = p.pos WHERE p.op = 'push' GROUP BY p.root, p.pos, p.hi, p.lo),
parts AS (
  SELECT f.*, cut.child AS to_id, 'no-' || cut.child AS to_no, cut.q, 0 AS at_end, ev.time AS e_time, ev.suffix AS e_suffix,
    ev.number AS e_number, ev.source_no AS e_source, ev.pos AS e_seq
  FROM cut JOIN fam f USING (seq) JOIN ev ON ev.pos = cut.pos WHERE cut.op = 'stay' AND cut.q > 0
  UNION ALL SELECT f.*, f.id, f.number, rest.q, 1, NULL, NULL, NULL, NULL, NULL FROM rest JOIN fam f USING (seq) WHERE rest.q > 0
  UNION ALL SELECT f.*, f.id, f.number, f.qty, 0, f.time, f.suffix, f.number, f.source_no, f.seq
  FROM fam f WHERE NOT is_split AND NOT own),
settled AS (
  SELECT to_id AS id, to_no AS final_no, item, q AS qty, price, employee, time, seq, 1 AS branch, root, at_end, e_time, e_suffix,
    e_number, e_source, e_seq, number, source_no FROM parts
  UNION ALL SELECT id0, source_no, item, qty, price, employee, time, seq, 2, NULL, 0, NULL, NULL, NULL, NULL, NULL,
    source_no, source_no FROM plain),
owed AS (SELECT *, sum(greatest(-qty, 0)) OVER (PARTITION BY id, item) AS owed,
  coalesce(sum(greatest(qty, 0)) OVER (PARTITION BY id, item ORDER BY {_LAST}
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later FROM settled WHERE qty <> 0),
net AS (SELECT * REPLACE (qty - least(qty, greatest(0, owed - later)) AS qty) FROM owed
  WHERE qty > 0 AND qty - least(qty, greatest(0, owed - later)) > 0)
SELECT id, final_no AS number, item, qty, price, employee, 'SALE_CHANGE' AS log_type, CAST(time AS DATE) AS date,
  strftime(time, '%V-%G') AS week, row_number() OVER (PARTITION BY id, item, qty ORDER BY {_LAST}) AS mark, seq, branch
FROM net"""

SQL["staff_order"] = f"WITH {ORDERS} SELECT * REPLACE (round(revenue, 2) AS revenue) FROM staff"

SQL["identified_rate"] = f"WITH {ORDERS}, {RATE} SELECT * FROM rate"

SQL["staff_kpi"] = f"""WITH {ORDERS}, {RATE}, totals AS (
  SELECT date, week, month, year, store, employee, round(sum(revenue), 2) AS revenue,
    CAST(sum(cancel_count) AS BIGINT) AS cancel_count, sum(cancel_qty) AS cancel_qty, CAST(sum(guests) AS BIGINT) AS guests,
    count(*) AS staff_invoices FROM staff GROUP BY ALL),
days AS (SELECT date, store, round(sum(revenue), 2) AS store_day_revenue, count(DISTINCT number) AS store_day_invoices
  FROM staff GROUP BY ALL)
SELECT t.*, coalesce(round_even(revenue / nullif(guests, 0) * 100, 0) / 100, 0) AS revenue_per_guest, identified_rate,
  store_day_revenue, store_day_invoices
FROM totals t LEFT JOIN (SELECT date, employee, identified_rate FROM rate) USING (date, employee)
  LEFT JOIN days USING (date, store)"""

SQL["customer_invoice"] = f"""WITH l AS (
  SELECT 'THU' || o_orderkey AS number, o_orderdate,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'S' || (o_custkey % 5) ELSE 'Thương' END AS store, o_totalprice AS total,
    printf('%02d:%02d', o_orderkey % 24, o_orderkey % 60) AS time_in, printf('%02d:%02d', o_custkey % 24, o_orderkey % 60) AS time_out,
    o_custkey % 24 AS h, o_orderpriority AS "table", l_linenumber AS guests, l_discount AS discount, {TIER} AS tier,
    'C' || o_custkey AS name, {PHONE} AS phone, {customer_class(PHONE, TIER)} AS customer_class,
    row_number() OVER (PARTITION BY o_orderkey ORDER BY p_name, {LINE}) AS n FROM {LINES})
SELECT {calendar('o_orderdate').replace("CAST(o_orderdate AS DATE) AS date", "CAST(o_orderdate AS DATE) - CASE WHEN h = 0 THEN 1 ELSE 0 END AS date")},
  number, strftime(o_orderdate, '%Y-%m-%d ') || time_out || ':00' AS time, store, total, time_in, time_out, "table", guests,
  discount, tier, name, phone, customer_class FROM l WHERE n = 1"""

SQL["history_append"] = """SELECT event_id, event_type, value, 0 AS user_id, CAST(NULL AS VARCHAR) AS mark FROM events
  WHERE CAST(ts AS DATE) < DATE '2024-01-16' AND event_type <> 'error'
UNION ALL SELECT event_id, NULL, CASE WHEN event_type = 'view' THEN 0 ELSE value END, user_id,
  CASE WHEN event_type = 'click' THEN 'x' END FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-16'"""

SQL["revenue_aov"] = f"""SELECT store, date, round(sum(net), 2) AS net, count(*) AS invoices,
  round_even(round(sum(net), 2) / count(*) * 100, 0) / 100 AS order_value FROM ({DAILY}) GROUP BY store, date"""

SQL["peak_hours"] = f"""SELECT store, hour_in, count(*) AS invoices,
  CAST(rank() OVER (PARTITION BY store ORDER BY count(*) DESC) AS INTEGER) AS busy_rank FROM ({DAILY}) GROUP BY store, hour_in"""

SQL["item_velocity"] = f"""WITH d AS (SELECT store, item, date, sum(qty) AS units FROM ({SALES}) GROUP BY ALL)
SELECT *, round_even(avg(units) OVER (PARTITION BY store, item ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING
  AND CURRENT ROW) * 100, 0) / 100 AS mean_units FROM d"""

SQL["guest_shares"] = f"""SELECT 'S' || (o_custkey % 5) AS store, strftime(o_orderdate, '%m-%Y') AS month, count(*) AS invoices,
  round_even(count(*) FILTER (WHERE c = 'Khách mới') / count(*) * 100, 0) / 100 AS new_share,
  round_even(count(*) FILTER (WHERE c = 'Khách quay lại') / count(*) * 100, 0) / 100 AS returning_share
FROM (SELECT *, {customer_class(PHONE, TIER)} AS c FROM orders) GROUP BY 1, 2"""

SQL["preferred_category"] = f"""SELECT customer_class, category, sum(qty) AS units FROM ({SALES}) GROUP BY customer_class, category
QUALIFY row_number() OVER (PARTITION BY customer_class ORDER BY sum(qty) DESC, category) = 1"""

SQL["staff_checkouts"] = f"""SELECT employee, month, round(sum(revenue), 2) AS revenue, count(DISTINCT number) AS checkouts
FROM ({SALES}) GROUP BY ALL"""

SQL["cancel_outliers"] = f"""WITH {ORDERS}, e AS (
  SELECT store, employee, count(*) AS orders, CAST(sum(cancel_count) AS BIGINT) AS cancelled,
    sum(cancel_count) / count(*) AS rate FROM staff GROUP BY ALL),
z AS (SELECT *, coalesce(round((rate - avg(rate) OVER s) / nullif(stddev_pop(rate) OVER s, 0), 4), 0) AS z FROM e
  WINDOW s AS (PARTITION BY store))
SELECT store, employee, orders, cancelled, round(rate, 4) AS cancel_rate, z, z > 1.0 AS outlier FROM z"""

SQL["price_override"] = f"""WITH l AS (
  SELECT o_custkey % 5 AS store, p_name AS item, CAST(round(l_discount * 100) AS INTEGER) AS price, l_orderkey, l_linenumber,
    l_extendedprice FROM {LINES}),
u AS (SELECT store, item, price AS usual_price FROM l GROUP BY store, item, price
  QUALIFY row_number() OVER (PARTITION BY store, item ORDER BY count(*) DESC, price) = 1)
SELECT l.*, usual_price FROM l JOIN u USING (store, item) WHERE price <> usual_price"""

SQL["close_time"] = f"""SELECT p_type AS category, count(*) AS lines,
  round(avg(date_diff('minute', o_orderdate, l_shipdate)), 4) AS mean_minutes,
  quantile_cont(date_diff('minute', o_orderdate, l_shipdate), 0.5) AS median_minutes FROM {LINES} GROUP BY p_type"""

SQL["upsell_rate"] = f"""WITH b AS (SELECT employee, number, max(CAST(category = 'PROMO' AS INTEGER)) AS hit
  FROM ({SALES}) GROUP BY ALL)
SELECT employee, count(*) AS bills, CAST(sum(hit) AS BIGINT) AS upsold, round_even(sum(hit) / count(*) * 100, 0) / 100 AS upsell_rate
FROM b GROUP BY employee"""

# Lines of the log and of the invoices, each with its number among equal ones; an open line takes the facts of the same
# line, then of the nearest one before or after it on the bill, then of the bill.
_FACTS = ("store", "number", "table_", "guests", "customer_class", "phone")
_B_LINE = ", ".join(f"{c.strip()} AS b_{c.strip()}" for c in LINE.split(","))
_B_ORDER = ", ".join(f"b_{c.strip()} NULLS LAST" for c in LINE.split(","))
MATCHED = f"""log AS (
  SELECT *, CASE WHEN id IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY id, item, l_quantity ORDER BY {NET_ORDER}) END AS mark
  FROM (SELECT CASE WHEN o_custkey % 11 <> 0 THEN 'O' || l_orderkey END AS id, p_type AS item, {LINE} FROM {LINES}
        WHERE l_linestatus = 'O')),
billed AS (
  SELECT *, CAST(trunc(qty) AS DOUBLE) AS whole, row_number() OVER (PARTITION BY id, item, qty ORDER BY {NET_ORDER.replace("l_", "b_l_")}) AS mark
  FROM (SELECT 'O' || l_orderkey AS id, p_type AS item, l_quantity + CASE WHEN l_partkey % 2 = 0 THEN 0.25 ELSE 0 END AS qty,
          CASE WHEN l_orderkey % 13 <> 0 AND l_partkey % 4 <> 0 THEN 'N' || l_orderkey END AS number,
          CASE WHEN l_partkey % 3 <> 0 THEN 'S' || (o_custkey % 5) END AS store,
          CASE WHEN l_suppkey % 2 = 0 THEN l_linenumber END AS guests, o_orderpriority AS table_, {PHONE} AS phone,
          {customer_class(PHONE, TIER)} AS customer_class, {_B_LINE} FROM {LINES} WHERE l_returnflag <> 'R')),
joined AS (
  SELECT l.*, b.* EXCLUDE (id, item, qty, whole, mark) FROM log l
  LEFT JOIN billed b ON l.id = b.id AND l.item = b.item AND l.l_quantity = b.whole AND l.mark = b.mark),
near AS (
  SELECT * EXCLUDE ({", ".join(_FACTS)}), number IS NOT NULL AS own, {", ".join(
      f"CASE WHEN id IS NOT NULL THEN coalesce(last_value({c} IGNORE NULLS) OVER up, first_value({c} IGNORE NULLS) OVER down) END AS {c}"
      for c in _FACTS)}
  FROM joined
  WINDOW up AS (PARTITION BY id ORDER BY item, l_shipdate, l_linenumber % 2, l_linenumber, {LINE}, {_B_ORDER}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    down AS (PARTITION BY id ORDER BY item, l_shipdate, l_linenumber % 2, l_linenumber, {LINE}, {_B_ORDER}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
firsts AS (
  SELECT id, max(guests) AS guests, {", ".join(
      f"first({c} ORDER BY number NULLS LAST, o_time, item, {_B_ORDER}) FILTER ({c} IS NOT NULL) AS {c}"
      for c in _FACTS if c != "guests")}
  FROM (SELECT b.*, o_orderdate AS o_time FROM billed b JOIN orders ON b_l_orderkey = o_orderkey) GROUP BY id),
matched AS (
  SELECT n.*, {", ".join(f"coalesce(n.{c}, f.{c}) AS found_{c}" for c in _FACTS)},
    CASE WHEN own THEN 'line' WHEN n.number IS NOT NULL THEN 'bill' WHEN f.number IS NOT NULL THEN 'id' ELSE 'none' END AS matched_by
  FROM near n LEFT JOIN firsts f ON n.id = f.id)"""

SQL["sales_lines"] = f"""WITH {MATCHED}
SELECT {calendar('l_shipdate')}, found_store AS store, found_number AS number, found_customer_class AS customer_class, item,
  l_extendedprice AS price, 'E' || l_suppkey AS employee, found_table_ AS "table", l_returnflag AS log_type,
  CAST(l_quantity AS INTEGER) AS qty, found_guests AS guests, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS time,
  l_extendedprice AS revenue, found_phone AS phone FROM matched WHERE found_number IS NOT NULL"""

SQL["match_residuals"] = f"WITH {MATCHED} SELECT matched_by, count(*) AS lines FROM matched GROUP BY ALL"

SQL["published_days"] = f"""SELECT *, CASE WHEN CAST(substr(number, 2) AS BIGINT) % 2 = 1 THEN DATE '2024-03-01' ELSE DATE '2024-03-02' END
  AS run_date FROM ({SQL["daily_invoice_report"]})"""

SQL["close_time_kept"] = f"""WITH m AS (
  SELECT CASE WHEN p_type <> 'PROMO' THEN 'of ' || p_type END AS category, o_orderkey % 180 AS minutes
  FROM {LINES} WHERE o_custkey % 7 <> 0)
SELECT category, count(*) AS lines, round(avg(minutes), 4) AS mean_minutes, median(minutes) AS median_minutes
FROM m GROUP BY category"""
