"""SQL statements that give the same results as the registered queries.

They are written against the test tables in plain SQL, apart from the Spark code: by
window functions where the library pre-aggregates, by direct columns where it goes
through change-log maps and JSON.
"""

from __future__ import annotations

DT = "'%Y-%m-%d %H:%M:%S'"

# --- named subqueries -------------------------------------------------------------------

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    CTE[name] = (needs, sql)


def _with(body: str, *needs: str) -> str:
    """The body with the subqueries it needs, and those they need, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for n in CTE[name][0]:
                add(n)
            order.append(name)

    for n in needs:
        add(n)
    parts = ",\n".join(f"{n} AS ({CTE[n][1]})" for n in order)
    return f"WITH {parts}\n{body}" if parts else body


def _win(column: str, size: str) -> str:
    return f"time_bucket(INTERVAL '{size}', {column}, TIMESTAMP '1970-01-01')"


def _bounds(size: str, day: str = "ws", fmt: str = "%Y%m%d") -> str:
    """Select list of window bounds for a grouped column ws."""
    end = f"ws + INTERVAL '{size}'"
    day = end if day == "we" else "ws"
    return (f"strftime(ws, {DT}) AS stt, strftime({end}, {DT}) AS edt, "
            f"strftime({day}, '{fmt}') AS cur_date")


_cte("ev", """
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts,
         make_timestamp(epoch_us(ts) // 1000 * 1000) AS et,
         CAST(user_id AS VARCHAR) AS usr, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events""")

_cte("pl", f"""
  SELECT seq, ts, et, k, event_type, usr AS mid, CASE WHEN k % 10 <> 0 THEN usr END AS uid,
         usr || '-' || strftime(et, '%Y-%m-%d') AS sid,
         concat('v', k % 3) AS vc, concat('ch', k % 5) AS ch, concat('ar', k % 7) AS ar,
         CASE WHEN k < 50 THEN '1' ELSE '0' END AS is_new,
         CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
              WHEN 'purchase' THEN 'trade' WHEN 'signup' THEN 'login'
              WHEN 'error' THEN 'search' END AS page_id,
         CASE k % 4 WHEN 1 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' END AS last_page_id,
         CASE WHEN k % 3 = 0 THEN b.text ELSE CAST(k AS VARCHAR) END AS item,
         CASE WHEN k % 3 = 0 THEN 'keyword' ELSE 'sku_id' END AS item_type,
         CAST(round(value * 1000) AS BIGINT) AS during_time
  FROM ev LEFT JOIN benchmark b ON b.item_id = ev.k""", "ev")

# Records that survive parsing, with the repaired flag.
_REPAIR = """
  SELECT p.* EXCLUDE (is_new),
         CASE WHEN is_new = '1' AND CAST(et AS DATE) <> stored THEN '0' ELSE is_new END AS is_new
  FROM (SELECT *, CASE WHEN first_value(is_new) OVER w = '1'
                       THEN CAST(first_value(et) OVER w AS DATE)
                       ELSE CAST(first_value(et) OVER w AS DATE) - 1 END AS stored
        FROM pl {where} WINDOW w AS (PARTITION BY mid ORDER BY ts, seq)) p"""
_cte("log", _REPAIR.format(where="WHERE k NOT BETWEEN 90 AND 94"), "pl")
_cte("log_all", _REPAIR.format(where=""), "pl")

_cte("gc", """
  SELECT seq, ts // 1000 AS ts, k,
         CASE WHEN k = 99 THEN 'other' ELSE 'shop' END AS db, concat('t', k % 8) AS tab,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'click' THEN 'update'
              WHEN 'view' THEN 'update' WHEN 'error' THEN 'delete'
              WHEN 'purchase' THEN 'bootstrap-insert' END AS kind,
         CASE WHEN k NOT IN (95, 96) THEN usr END AS id,
         CASE WHEN k NOT IN (95, 96) AND k >= 20 THEN concat('n', k) END AS name,
         CASE WHEN k NOT IN (95, 96) THEN CAST(CAST(round(value) AS BIGINT) AS VARCHAR) END AS score,
         CASE WHEN event_type IN ('click', 'view') THEN CAST(k AS VARCHAR) END AS old_score
  FROM ev""", "ev")

# Changes that pass the dimension filter, parsing included.
_cte("gd", "SELECT * FROM gc WHERE k NOT BETWEEN 90 AND 96 AND db = 'shop'", "gc")

_cte("cfg", """
  SELECT seq, CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'u' WHEN 'view' THEN 'u'
                   WHEN 'purchase' THEN 'r' WHEN 'error' THEN 'd' END AS op,
         concat('t', (k // 10) % 8) AS source_table,
         CASE WHEN k % 10 < 5 THEN 'insert' ELSE 'update' END AS source_type,
         CASE WHEN k % 2 = 0 THEN 'id,name' ELSE 'id,score' END AS sink_columns
  FROM ev""", "ev")

_cte("live", """
  SELECT source_table, 'dim_' || source_table AS sink_table, sink_columns
  FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) AS rn FROM cfg)
  WHERE rn = 1 AND op <> 'd'""", "cfg")

# A reload of a configuration row counts as preloaded, before every other change.
_cte("live_facts", """
  SELECT source_table, source_type, 'dwd_' || source_table AS sink_table, sink_columns
  FROM (SELECT *, row_number() OVER (PARTITION BY source_table, source_type
                                     ORDER BY (op = 'r'), seq DESC) AS rn FROM cfg)
  WHERE rn = 1 AND op <> 'd'""", "cfg")

_cte("oc", """
  SELECT o_orderkey, o_custkey, o_orderstatus AS st, o_orderdate,
         split_part(o_orderpriority, '-', 1) AS pri, CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS user_id, CAST(c_nationkey AS VARCHAR) AS province_id
  FROM orders JOIN customer ON c_custkey = o_custkey""")

_cte("dic", """
  SELECT DISTINCT split_part(o_orderpriority, '-', 1) AS code,
         split_part(o_orderpriority, '-', 2) AS name
  FROM orders WHERE o_orderpriority NOT LIKE '%NOT SPECIFIED'""")

_cte("ln", """
  SELECT concat(l_orderkey, '-', l_linenumber) AS id, l_orderkey, l_partkey, l_suppkey,
         l_linenumber, l_returnflag AS rf, l_linestatus AS ls, l_shipdate, l_discount, l_tax,
         CAST(l_partkey AS VARCHAR) AS sku_id,
         CAST(l_quantity AS DECIMAL(16,2)) AS qty, CAST(l_extendedprice AS DECIMAL(16,2)) AS price,
         CASE WHEN l_discount > 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(16,2))
              * CAST(l_discount AS DECIMAL(16,2)) AS DECIMAL(20,4)) END AS act_amt,
         CASE WHEN l_tax > 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(16,2))
              * CAST(l_tax AS DECIMAL(16,2)) AS DECIMAL(20,4)) END AS cou_amt,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts
  FROM lineitem""")

_cte("od", f"""
  SELECT ln.id, order_id, user_id, sku_id, p_name AS sku_name, province_id,
         CAST(a.s AS VARCHAR) AS activity_id, CASE WHEN a.id IS NOT NULL THEN '1' END AS activity_rule_id,
         CAST(c.s AS VARCHAR) AS coupon_id, strftime(l_shipdate, '%Y-%m-%d') AS date_id,
         strftime(l_shipdate, {DT}) AS create_time, CAST(qty AS VARCHAR) AS sku_num,
         CAST(qty * CAST(p_retailprice AS DECIMAL(16,2)) AS DECIMAL(20,4)) AS orig,
         act_amt, cou_amt, price, ts, l_shipdate AS et
  FROM ln JOIN oc ON oc.o_orderkey = ln.l_orderkey JOIN part ON p_partkey = l_partkey
  LEFT JOIN (SELECT id, max(l_suppkey) AS s FROM ln WHERE l_discount > 0.05 GROUP BY id) a ON a.id = ln.id
  LEFT JOIN (SELECT id, min(l_suppkey) AS s FROM ln WHERE l_tax > 0.04 GROUP BY id) c ON c.id = ln.id""",
     "ln", "oc")

_cte("delta", """
  SELECT id, coalesce(p_et, et) AS et, coalesce(p_sku, sku_id) AS sku_id,
         orig - coalesce(p_orig, 0) AS original_amount, a - coalesce(p_a, 0) AS activity_reduce_amount,
         c - coalesce(p_c, 0) AS coupon_reduce_amount, price - coalesce(p_price, 0) AS order_amount
  FROM (SELECT *, lag(et) OVER w AS p_et, lag(sku_id) OVER w AS p_sku, lag(orig) OVER w AS p_orig,
               lag(a) OVER w AS p_a, lag(c) OVER w AS p_c, lag(price) OVER w AS p_price
        FROM (SELECT id, et, sku_id, orig, coalesce(act_amt, 0) AS a, coalesce(cou_amt, 0) AS c, price
              FROM od)
        WINDOW w AS (PARTITION BY id ORDER BY et, sku_id, orig, a, c, price))""", "od")

_cte("paid", f"""
  SELECT order_id AS paid_order, pri, o_orderdate + INTERVAL 5 DAY AS pt
  FROM oc WHERE st = 'F'""", "oc")

_cte("pay", """
  SELECT od.*, paid.pri, paid.pt, dic.name AS pay_name
  FROM paid JOIN od ON od.order_id = paid.paid_order
   AND od.et BETWEEN paid.pt - INTERVAL 30 DAY AND paid.pt + INTERVAL 5 DAY
  JOIN dic ON dic.code = paid.pri""", "paid", "od", "dic")

_cte("rr", """
  SELECT ln.*, oc.order_id, oc.user_id, oc.province_id, oc.pri, oc.st,
         CAST(least(l_linenumber, 5) AS VARCHAR) AS reason
  FROM ln JOIN oc ON oc.o_orderkey = ln.l_orderkey WHERE rf = 'R'""", "ln", "oc")

_cte("refunds", """
  SELECT rr.*, d1.name AS type_name, d2.name AS reason_name FROM rr
  JOIN dic d1 ON d1.code = rr.pri JOIN dic d2 ON d2.code = rr.reason
  WHERE rr.st <> 'P'""", "rr", "dic")

_cte("carts", """
  SELECT CAST(seq AS VARCHAR) AS id, usr AS user_id, CAST(k AS VARCHAR) AS sku_id,
         CASE WHEN event_type IN ('signup', 'purchase') THEN k % 5 + 1
              ELSE k % 5 + 1 - k % 7 END AS sku_num,
         ts // 1000 AS ts
  FROM ev WHERE event_type IN ('signup', 'purchase')
     OR (event_type IN ('view', 'click') AND k % 5 + 1 > k % 7)""", "ev")

_cte("prov", """
  SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, r_name AS region
  FROM nation JOIN region ON r_regionkey = n_regionkey""")

_cte("sku", """
  SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_name AS sku_name, p_name AS spu_id,
         upper(p_name) AS spu_name, p_brand AS trademark_id,
         CASE WHEN p_brand <> 'Brand#13' THEN upper(p_brand) END AS trademark_name,
         p_type AS category3_id, lower(p_type) AS category3_name,
         CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'sized' ELSE 'plain' END AS category2_id,
         CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'SIZED' ELSE 'PLAIN' END AS category2_name,
         CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 's' ELSE 'p' END AS category1_id,
         CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'Sized' ELSE 'Plain' END AS category1_name
  FROM part""")

SKU_COLUMNS = ("sku_name, spu_id, trademark_id, category3_id, spu_name, trademark_name, "
               "category3_name, category2_id, category2_name, category1_id, category1_name")


# --- windowed tables as subqueries --------------------------------------------------------

def _traffic(size: str) -> str:
    return f"""
  SELECT {_bounds(size)}, vc, ch, ar, is_new, CAST(sum(uv) AS BIGINT) AS uv_ct,
         CAST(sum(sv) AS BIGINT) AS sv_ct, count(*) AS pv_ct,
         CAST(sum(during_time) AS BIGINT) AS dur_sum, CAST(sum(uj) AS BIGINT) AS uj_ct
  FROM (SELECT *, {_win('et', size)} AS ws,
          CASE WHEN row_number() OVER (PARTITION BY mid, CAST(et AS DATE) ORDER BY ts, seq) = 1
               THEN 1 ELSE 0 END AS uv,
          CASE WHEN row_number() OVER (PARTITION BY sid ORDER BY ts, seq) = 1 THEN 1 ELSE 0 END AS sv,
          CASE WHEN count(*) OVER (PARTITION BY sid) = 1 THEN 1 ELSE 0 END AS uj
        FROM log)
  GROUP BY ws, vc, ch, ar, is_new"""


_cte("traffic", _traffic("1 day"), "log")
_cte("traffic_hour", _traffic("1 hour"), "log")


def _hd_first(source: str) -> str:
    return f"""
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, page_id, CAST(et AS DATE)
                                              ORDER BY ts, seq) AS rn
                 FROM {source} WHERE page_id IN ('home', 'good_detail')) WHERE rn = 1"""


_cte("hd_first", _hd_first("pl"), "pl")
_cte("hd_first_log", _hd_first("log"), "log")

_cte("home_detail", f"""
  SELECT {_bounds('1 day')}, CAST(count(*) FILTER (page_id = 'home') AS BIGINT) AS home_uv_ct,
         CAST(count(*) FILTER (page_id = 'good_detail') AS BIGINT) AS good_detail_uv_ct
  FROM (SELECT *, {_win('et', '1 day')} AS ws FROM hd_first_log) GROUP BY ws""", "hd_first_log")

_SEARCH = "last_page_id IN ('search', 'home') AND item_type = 'keyword' AND item IS NOT NULL"


def _kw(source: str) -> str:
    return rf"""
  SELECT * FROM (SELECT seq, et, unnest(list_distinct(
             regexp_split_to_array(lower(item), '[^\p{{L}}\p{{N}}]+'))) AS keyword
                 FROM {source} WHERE {_SEARCH}) WHERE keyword <> ''"""


_cte("kw", _kw("pl"), "pl")
_cte("kw_log", _kw("log"), "log")

_cte("keyword", f"""
  SELECT {_bounds('1 day')}, keyword, count(*) AS keyword_count, 'SEARCH' AS source
  FROM (SELECT *, {_win('et', '1 day')} AS ws FROM kw_log) GROUP BY ws, keyword""", "kw_log")


def _login_days(source: str) -> str:
    return f"""
  SELECT *, lag(CAST(et AS DATE)) OVER (PARTITION BY uid ORDER BY et) AS prev
  FROM (SELECT *, row_number() OVER (PARTITION BY uid, CAST(et AS DATE) ORDER BY ts, seq) AS rn
        FROM {source} WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login'))
  WHERE rn = 1"""


_cte("login_days", _login_days("pl"), "pl")
_cte("login_days_log", _login_days("log"), "log")


def _back(days: int) -> str:
    return (f"CASE WHEN prev IS NOT NULL AND floor((ts - epoch_ms(CAST(prev AS TIMESTAMP)))"
            f" / 86400000.0) > {days} THEN 1 ELSE 0 END")


_cte("login", f"""
  SELECT {_bounds('1 day')}, CAST(sum({_back(7)}) AS BIGINT) AS back_ct, count(*) AS uu_ct
  FROM (SELECT *, {_win('et', '1 day')} AS ws FROM login_days_log) GROUP BY ws""", "login_days_log")

_cte("register", f"""
  SELECT {_bounds('1 hour', 'we')}, count(*) AS register_ct
  FROM (SELECT {_win('et', '1 hour')} AS ws FROM ev WHERE event_type = 'signup') GROUP BY ws""",
     "ev")

_cte("cart_first", """
  SELECT user_id, min(ts) AS ts FROM carts
  GROUP BY user_id, CAST(make_timestamp(ts * 1000000) AS DATE)""", "carts")

_cte("cart", f"""
  SELECT {_bounds('1 day')}, count(*) AS cart_add_uu_ct
  FROM (SELECT {_win('make_timestamp(ts * 1000000)', '1 day')} AS ws FROM cart_first)
  GROUP BY ws""", "cart_first")

_USERS = """
  SELECT user_id, ts, 1 AS uu_ct, CASE WHEN ts = min(ts) OVER (PARTITION BY user_id)
         THEN 1 ELSE 0 END AS new_ct
  FROM (SELECT DISTINCT user_id, {ts} AS ts FROM {table})"""
_cte("order_first", _USERS.format(ts="ts", table="od"), "od")
_cte("pay_first", _USERS.format(ts="CAST(epoch(pt) AS BIGINT)", table="pay"), "pay")


def _user_window(table: str, unique: str, new: str) -> str:
    return f"""
  SELECT {_bounds('30 days')}, CAST(sum(uu_ct) AS BIGINT) AS {unique},
         CAST(sum(new_ct) AS BIGINT) AS {new}
  FROM (SELECT *, {_win('make_timestamp(ts * 1000000)', '30 days')} AS ws FROM {table})
  GROUP BY ws"""


_cte("order_users", _user_window("order_first", "order_unique_user_count", "order_new_user_count"),
     "order_first")
_cte("payment_users", _user_window("pay_first", "payment_suc_unique_user_count",
                                   "payment_suc_new_user_count"), "pay_first")

_cte("once", """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id
                   ORDER BY ts, sku_id, province_id, order_id, price) AS rn FROM od)
  WHERE rn = 1""", "od")

_cte("province", f"""
  SELECT g.*, prov.name AS province_name
  FROM (SELECT {_bounds('30 days')}, province_id, count(DISTINCT order_id) AS order_count,
               sum(price) AS order_amount
        FROM (SELECT *, {_win('et', '30 days')} AS ws FROM once) GROUP BY ws, province_id) g
  LEFT JOIN prov ON prov.id = g.province_id""", "once", "prov")

_cte("cats", """
  SELECT DISTINCT category3_id, category3_name, category2_id, category2_name, category1_id,
         category1_name FROM sku""", "sku")
_cte("brands", "SELECT DISTINCT trademark_id, trademark_name FROM sku", "sku")

_cte("refund", f"""
  SELECT g.*, trademark_name, category3_name, category2_id, category2_name, category1_id,
         category1_name
  FROM (SELECT {_bounds('30 days', fmt='%Y-%m-%d')}, trademark_id, category3_id, user_id,
               count(DISTINCT order_id) AS refund_count
        FROM (SELECT {_win('l_shipdate', '30 days')} AS ws, trademark_id, category3_id, user_id,
                     order_id
              FROM refunds LEFT JOIN sku USING (sku_id))
        GROUP BY ws, trademark_id, category3_id, user_id) g
  LEFT JOIN cats USING (category3_id) LEFT JOIN brands USING (trademark_id)""",
     "refunds", "sku", "cats", "brands")

_cte("sku_order", f"""
  SELECT g.*, {SKU_COLUMNS}
  FROM (SELECT {_bounds('30 days', 'we')}, sku_id, sum(original_amount) AS original_amount,
               sum(activity_reduce_amount) AS activity_reduce_amount,
               sum(coupon_reduce_amount) AS coupon_reduce_amount, sum(order_amount) AS order_amount
        FROM (SELECT *, {_win('et', '30 days')} AS ws FROM delta) GROUP BY ws, sku_id) g
  LEFT JOIN sku USING (sku_id)""", "delta", "sku")


# --- statements ---------------------------------------------------------------------------

def _dbl(*names: str) -> str:
    return ", ".join(f"round(CAST({n} AS DOUBLE), 4) AS {n}" for n in names)


_SKU_AMOUNTS = ("original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount")
_OK = "k NOT BETWEEN 90 AND 94"
_SPLIT = ("CAST(orig AS VARCHAR) AS split_original_amount, "
          "CAST(act_amt AS VARCHAR) AS split_activity_amount, "
          "CAST(cou_amt AS VARCHAR) AS split_coupon_amount")
_OD_HEAD = ("order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, "
            "coupon_id")
_KEPT = """CASE WHEN list_contains(string_split(sink_columns, ','), 'name') THEN name END AS name,
         CASE WHEN list_contains(string_split(sink_columns, ','), 'score') THEN score END AS score"""


def _channel(expr: str, name: str) -> str:
    return _with(f"SELECT ch, {expr} AS {name} FROM traffic GROUP BY ch", "traffic")


def _ratio(a: str, b: str) -> str:
    return f"round(CAST(sum({a}) AS DOUBLE) / nullif(CAST(sum({b}) AS DOUBLE), 0), 6)"


def _reduction(amount: str, rate: str) -> str:
    return _with(f"""
SELECT round(CAST(sum({amount}) AS DOUBLE), 4) AS {amount},
       round(CAST(sum(original_amount) AS DOUBLE), 4) AS origin_total_amount,
       {_ratio(amount, 'original_amount')} AS {rate}
FROM sku_order""", "sku_order")


def _orders_refunds(ids: str, names: str) -> str:
    on = " AND ".join(f"o.{i} = r.{i}" for i in ids.split(", "))
    shown = ", ".join(f"o.{n}" for n in names.split(", "))
    return _with(f"""
SELECT {shown}, order_amount, refund_count, refund_uu_count
FROM (SELECT {ids}, {names}, round(CAST(sum(order_amount) AS DOUBLE), 4) AS order_amount
      FROM sku_order GROUP BY {ids}, {names}) o
FULL OUTER JOIN (SELECT {ids}, {names}, CAST(sum(refund_count) AS BIGINT) AS refund_count,
                        count(DISTINCT user_id) AS refund_uu_count
                 FROM refund GROUP BY {ids}, {names}) r ON {on}""", "sku_order", "refund")


def _sum(name: str, table: str) -> str:
    return f"(SELECT CAST(sum({name}) AS BIGINT) FROM {table})"


def _labels(key: str, value: str, *rows: tuple[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{label}' AS {key}, {expr} AS {value}"
                              for label, expr in rows)


_TYPES = """
  SELECT is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
         CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct,
         CAST(sum(dur_sum) AS BIGINT) AS dur_sum,
         CASE WHEN sum(sv_ct) = 0 THEN 0.0 ELSE CAST(sum(uj_ct) AS DOUBLE) / CAST(sum(sv_ct) AS DOUBLE) END AS uj_rate,
         CASE WHEN sum(sv_ct) = 0 THEN 0.0 ELSE CAST(sum(dur_sum) AS DOUBLE) / CAST(sum(sv_ct) AS DOUBLE) / 1000 END AS avg_dur_sum,
         CASE WHEN sum(sv_ct) = 0 THEN 0.0 ELSE CAST(sum(pv_ct) AS DOUBLE) / CAST(sum(sv_ct) AS DOUBLE) END AS avg_pv_ct
  FROM traffic GROUP BY is_new"""


def _pivot_row(name: str) -> str:
    return (f"SELECT '{name}' AS type, "
            f"round(coalesce(sum(CAST({name} AS DOUBLE)) FILTER (is_new = '1'), 0), 6) AS new_visitor, "
            f"round(coalesce(sum(CAST({name} AS DOUBLE)) FILTER (is_new <> '1'), 0), 6) AS old_visitor "
            f"FROM types")


_cte("types", _TYPES, "traffic")


def _of_newest_day(sql: str, needs: tuple[str, ...], tables: tuple[str, ...]) -> str:
    """A report over one day: its tables are cut to the newest day of the last of them."""
    head = _with("", *needs)
    assert sql.startswith(head)
    out = _with(sql[len(head):], tables[-1], *needs)
    day = f"(SELECT replace(max(cur_date), '-', '') FROM {tables[-1]}_all)"
    for t in tables:
        whole = f"{t} AS ({CTE[t][1]})"
        assert whole in out
        out = out.replace(whole, f"{t}_all AS ({CTE[t][1]}),\n{t} AS (SELECT * FROM {t}_all "
                                 f"WHERE replace(cur_date, '-', '') = {day})")
    return out


#: Reports that are also registered for one day: subqueries they need, tables cut to the day.
_DAY_REPORTS = {
    "ads_channel_uv": (("traffic",), ("traffic",)),
    "ads_visitor_type": (("types",), ("traffic",)),
    "ads_visitor_per_hour": (("traffic_hour",), ("traffic_hour",)),
    "ads_keywords": (("keyword",), ("keyword",)),
    "ads_province_amount": (("province",), ("province",)),
    "ads_trademark": (("sku_order", "refund"), ("sku_order", "refund")),
    "ads_category": (("sku_order", "refund"), ("sku_order", "refund")),
    "ads_trade_stats": (("province", "order_users", "refund"), ("province", "order_users", "refund")),
}
#: Tables made from the mixed log, through stored layers, as from their own branches.
_FROM_LOG = {"log_order_detail": "dwd_trade_order_detail", "log_refund": "dwd_trade_refund",
             "log_refund_pay_suc": "dwd_refund_pay_suc", "log_pay_suc": "dwd_trade_pay_suc",
             "log_province_order": "dws_province_order"}


def statements() -> dict[str, str]:
    found = _statements()
    found |= {name: found[same] for name, same in _FROM_LOG.items()}
    return found | {f"{name}_day": _of_newest_day(found[name], *how) for name, how in _DAY_REPORTS.items()}


def _statements() -> dict[str, str]:
    at = f"strftime(et, {DT})"
    return {
        # sources
        "src_raw_json": _with(f"""
SELECT CASE WHEN {_OK} THEN seq END AS seq,
       CASE k WHEN 90 THEN '{{bad' WHEN 91 THEN '[1]' WHEN 92 THEN '123' WHEN 93 THEN '' END AS broken
FROM ev WHERE k <> 94""", "ev"),
        "src_change_log": _with(f"""
SELECT db AS "database", tab AS "table", kind AS type, ts, seq, strftime(make_timestamp(ts * 1000000), {DT}) AS at,
       old_score, id, name, score FROM gc WHERE {_OK}""", "gc"),
        "src_page_log": _with(f"""
SELECT seq, {at} AS at, page_id, item_type, item FROM pl WHERE {_OK}""", "pl"),
        "src_fact_reread": _with(f"SELECT id, order_id, ts, {at} AS at FROM od", "od"),
        "lkp_dictionary": _with("SELECT code AS dic_code, name AS dic_name FROM dic", "dic"),
        "cdc_config_decode": _with("""
SELECT op, seq, source_table, 'dim_' || source_table AS sink_table, sink_columns,
       'info' AS sink_family, 'id' AS sink_row_key FROM cfg""", "cfg"),
        "cdc_config_snapshot": _with("""
SELECT source_table, 'dim_' || source_table AS sink_table, arg_max(sink_columns, seq) AS sink_columns,
       'info' AS sink_family, 'id' AS sink_row_key FROM cfg WHERE op = 'r' GROUP BY source_table""", "cfg"),
        "cdc_config_active": _with("""
SELECT source_table, sink_table, sink_columns, 'info' AS sink_family, 'id' AS sink_row_key
FROM live""", "live"),

        # configured tables
        "dwd_routed_facts": _with(f"""
SELECT sink_table, ts, seq, id, {_KEPT}, CAST(NULL AS VARCHAR) AS note
FROM gd JOIN live_facts ON source_table = tab AND source_type = kind""", "gd", "live_facts"),
        "upsert_latest": _with("""
SELECT source, id, name, score, ts, seq
FROM (SELECT *, tab AS source, row_number() OVER (PARTITION BY tab, id ORDER BY ts DESC, seq DESC) AS rn
      FROM gd) WHERE rn = 1 AND kind <> 'delete'""", "gd"),
        "dim_config_route": _with(f"""
SELECT sink_table, 'info' AS sink_family, id AS row_key, kind AS op_type, ts, seq, id, {_KEPT},
       CAST(NULL AS VARCHAR) AS note
FROM gd JOIN live ON source_table = tab""", "gd", "live"),
        "dim_latest": _with(f"""
, kept AS (
  SELECT sink_table, id AS row_key, seq, ts, kind, id, {_KEPT}
  FROM gd JOIN live ON source_table = tab),
alive AS (
  SELECT kept.* FROM kept
  LEFT JOIN (SELECT sink_table, row_key, max(struct_pack(ts, seq)) AS gone FROM kept
             WHERE kind = 'delete' GROUP BY sink_table, row_key) d USING (sink_table, row_key)
  WHERE kind <> 'delete' AND (gone IS NULL OR struct_pack(ts, seq) > gone))
SELECT sink_table, row_key, last(id ORDER BY ts, seq) AS id,
       last(name ORDER BY ts, seq) FILTER (name IS NOT NULL) AS name,
       last(score ORDER BY ts, seq) FILTER (score IS NOT NULL) AS score
FROM alive GROUP BY sink_table, row_key""".lstrip(), "gd", "live"),
        "dim_targets": _with("""
SELECT DISTINCT 'dim_' || cfg.source_table AS sink_table, 'info' AS sink_family,
       CAST(CASE WHEN live.source_table IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS in_effect
FROM cfg LEFT JOIN live ON live.source_table = cfg.source_table WHERE op <> 'd'""", "cfg", "live"),

        # projections and filters
        "etl_valid_json": _with(f"SELECT seq, mid FROM pl WHERE {_OK}", "pl"),
        "etl_change_log_dim": _with("""
SELECT db AS "database", tab AS "table", kind AS type, ts, seq, id, score FROM gd""", "gd"),
        "etl_change_log_dwd": _with("""
SELECT db AS "database", tab AS "table", kind AS type, ts, seq, id, score FROM gd
WHERE kind IN ('insert', 'update')""", "gd"),
        "prj_map_extract": _with("""
SELECT id, name, score AS points, CAST(NULL AS VARCHAR) AS absent, ts FROM gc""", "gc"),
        "prj_config_columns": _with("""
SELECT seq, CASE WHEN k = 95 THEN NULL WHEN k = 96 THEN 'op_type'
                 WHEN sink_columns = 'id,name' THEN 'id,name,op_type'
                 ELSE 'id,op_type,score' END AS names,
       CASE WHEN k <> 95 THEN kind END AS op_type,
       CASE WHEN sink_columns = 'id,score' THEN score END AS score
FROM gc JOIN live ON source_table = tab""", "gc", "live"),
        "flt_status_exact": _with(f"""
SELECT order_id AS id, user_id, strftime(o_orderdate + INTERVAL 1 DAY, {DT}) AS operate_time,
       CAST(epoch(o_orderdate + INTERVAL 1 DAY) AS BIGINT) AS ts
FROM oc WHERE st = 'P'""", "oc"),
        "flt_status_changed": _with("""
SELECT 'payment_info' AS source, '1602' AS status, order_id AS id, CAST(epoch(o_orderdate) AS BIGINT) + 5 * 86400 AS ts
FROM oc WHERE st = 'F'
UNION ALL SELECT 'order_info', '1005', order_id, CAST(epoch(o_orderdate) AS BIGINT) + 6 * 86400 FROM oc WHERE st <> 'P'
UNION ALL SELECT 'order_info', '1006', order_id, CAST(epoch(o_orderdate) AS BIGINT) + 7 * 86400 FROM oc WHERE st = 'F'
UNION ALL SELECT 'order_refund_info', '0705', id, ts + 86400 FROM ln WHERE rf = 'R' AND ls = 'F'
UNION ALL SELECT 'refund_payment', '1602', id, ts + 86400 FROM ln WHERE rf = 'R' AND ls = 'F'""", "oc", "ln"),
        "flt_login": _with("""
SELECT seq, ts, uid, last_page_id FROM pl
WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')""", "pl"),
        "flt_keyword": _with(f"SELECT seq, ts, item FROM pl WHERE {_SEARCH}", "pl"),
        "fn_decimal_amount": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(CAST(l_quantity AS DECIMAL(16,2)) AS VARCHAR) AS sku_num,
       CAST(CAST(CAST(l_quantity AS DECIMAL(16,2)) * CAST(p_retailprice AS DECIMAL(16,2))
            AS DECIMAL(20,4)) AS VARCHAR) AS amount
FROM lineitem JOIN part ON p_partkey = l_partkey""",
        "fn_amount_default": _with("""
SELECT id, ts, sku_id, coalesce(CAST(act_amt AS DOUBLE), 0) AS activity,
       coalesce(CAST(cou_amt AS DOUBLE), 0) AS coupon FROM od""", "od"),
        "fn_date_formats": _with(f"""
SELECT seq, {at} AS datetime, strftime(et, '%Y-%m-%d') AS date, strftime(et, '%Y%m%d') AS partition_date,
       strftime(et, '%Y-%m-%d') AS date_id, epoch_ms(date_trunc('second', et)) AS datetime_ms,
       epoch_ms(CAST(CAST(et AS DATE) AS TIMESTAMP)) AS date_ms FROM ev""", "ev"),
        "fn_epoch": _with(f"""
SELECT seq, {at} AS from_millis, {at} AS from_seconds, ts % 1000 AS millis FROM ev""", "ev"),
        "prj_nested": _with("""
SELECT seq, mid, page_id, CASE WHEN event_type = 'signup' THEN 'icon' END AS entry,
       CASE WHEN event_type = 'error' THEN CAST(k AS BIGINT) END AS error_code FROM pl""", "pl"),

        # behaviour log
        "dwd_start": _with("""
SELECT seq, ts, mid, is_new, 'icon' AS entry, CAST(k AS BIGINT) AS loading_time,
       CAST(k % 4 AS BIGINT) AS displays FROM log WHERE event_type = 'signup'""", "log"),
        "dwd_display": _with("""
SELECT mid, uid, sid, vc, ch, ar, is_new, CAST(k + i AS VARCHAR) AS item, CAST(i AS BIGINT) AS pos, ts
FROM (SELECT *, unnest(range(1, k % 4 + 1)) AS i FROM log)""", "log"),
        "dwd_action": _with("""
SELECT mid, uid, sid, vc, ch, ar, is_new, concat('a', i) AS action_id, CAST(k - i AS VARCHAR) AS item,
       CAST(ts + i AS BIGINT) AS ts
FROM (SELECT *, unnest(range(1, k % 3 + 1)) AS i FROM log)""", "log"),
        "dwd_err": _with("""
SELECT seq, ts, mid, is_new, CAST(k AS BIGINT) AS error_code, event_type AS msg, page_id
FROM log WHERE event_type = 'error'""", "log"),
        "dwd_page": _with("""
SELECT seq, ts, mid, uid, sid, vc, ch, ar, is_new, page_id, last_page_id, item, item_type, during_time
FROM log""", "log"),

        # joins
        "join_inner": _with("""
SELECT id, ln.sku_id, order_id, ts, user_id, province_id
FROM ln JOIN oc ON oc.o_orderkey = ln.l_orderkey""", "ln", "oc"),
        "join_left_chain": _with("""
SELECT id, sku_id, ts, CAST(price AS VARCHAR) AS split_total_amount, activity_id, activity_rule_id,
       coupon_id FROM od""", "od"),
        "join_composite": _with("""
SELECT p.order_id, p.sku_id, p.id, CAST(p.price AS VARCHAR) AS total_amount, p.ts + 86400 AS ts,
       CAST(r.qty AS VARCHAR) AS refund_num
FROM rr p JOIN rr r ON r.order_id = p.order_id AND r.sku_id = p.sku_id
WHERE p.ls = 'F' AND r.ls = 'F'""", "rr"),
        "join_interval": _with(f"""
SELECT id, order_id, sku_id, CAST(price AS VARCHAR) AS split_total_amount, pri AS payment_type,
       {at} AS ordered_at, strftime(pt, {DT}) AS paid_at
FROM paid JOIN od ON od.order_id = paid.paid_order
 AND od.et >= paid.pt - INTERVAL 30 DAY AND od.et <= paid.pt + INTERVAL 5 DAY""", "paid", "od"),
        "join_lookup": _with("""
SELECT order_id, pri AS payment_type, CAST(epoch(o_orderdate) AS BIGINT) + 5 * 86400 AS ts,
       dic.name AS payment_type_name
FROM oc JOIN dic ON dic.code = pri WHERE st <> 'P'""", "oc", "dic"),
        "join_lookup_twice": _with("""
SELECT id, sku_id, pri AS refund_type, reason AS refund_reason_type, ts, d1.name AS refund_type_name,
       d2.name AS refund_reason_type_name
FROM rr JOIN dic d1 ON d1.code = pri JOIN dic d2 ON d2.code = reason""", "rr", "dic"),
        "join_lateral_words": _with("SELECT seq, keyword FROM kw", "kw"),
        "enrich_one_hop": _with("""
SELECT od.id, sku_id, ts, province_id, CAST(price AS VARCHAR) AS split_total_amount,
       prov.name AS province_name, prov.region AS region_name
FROM od LEFT JOIN prov ON prov.id = province_id""", "od", "prov"),
        "enrich_snowflake": _with(f"""
SELECT od.id, od.sku_id, od.ts, CAST(price AS VARCHAR) AS split_total_amount,
       {', '.join('s.' + c for c in SKU_COLUMNS.split(', '))}
FROM od LEFT JOIN sku s ON s.sku_id = od.sku_id""", "od", "sku"),

        # windows and aggregates
        "agg_window_keyed": _with(f"""
SELECT {_bounds('30 days')}, sku_id, {_dbl(*_SKU_AMOUNTS)}
FROM (SELECT {_win('et', '30 days')} AS ws, sku_id, sum(orig) AS original_amount,
             sum(coalesce(act_amt, 0)) AS activity_reduce_amount,
             sum(coalesce(cou_amt, 0)) AS coupon_reduce_amount, sum(price) AS order_amount
      FROM od GROUP BY ALL)""", "od"),
        "agg_window_global": _with(f"""
SELECT {_bounds('5 seconds')}, CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM (SELECT *, {_win('et', '5 seconds')} AS ws FROM pl) GROUP BY ws""", "pl"),
        "agg_window_distinct": _with(f"""
SELECT {_bounds('30 days')}, province_id, count(DISTINCT order_id) AS order_count
FROM (SELECT *, {_win('et', '30 days')} AS ws FROM od) GROUP BY ws, province_id""", "od"),
        "win_tumble": _with(f"""
SELECT {_bounds('5 seconds')}, page_id, count(*) AS n
FROM (SELECT *, {_win('et', '5 seconds')} AS ws FROM pl) GROUP BY ws, page_id""", "pl"),
        "win_bounds": _with(f"""
, h AS (SELECT {_win('et', '1 hour')} AS ws, count(*) AS n FROM pl GROUP BY 1)
SELECT 'start' AS day_from, {_bounds('1 hour')}, n FROM h
UNION ALL SELECT 'end', {_bounds('1 hour', 'we')}, n FROM h
UNION ALL SELECT 'iso', {_bounds('1 hour', fmt='%Y-%m-%d')}, n FROM h""".lstrip(), "pl"),

        # keyed state
        "st_is_new_repair": _with("SELECT seq, ts, mid, is_new FROM log_all", "log_all"),
        "st_uv_first_of_day": _with("""
SELECT seq, ts, mid, page_id, strftime(et, '%Y-%m-%d') AS day,
       CAST(CASE WHEN row_number() OVER (PARTITION BY mid, CAST(et AS DATE) ORDER BY ts, seq) = 1
                 THEN 1 ELSE 0 END AS BIGINT) AS uv_ct FROM pl""", "pl"),
        "st_session_first": _with("""
SELECT seq, ts, sid, CAST(CASE WHEN row_number() OVER (PARTITION BY sid ORDER BY ts, seq) = 1
                               THEN 1 ELSE 0 END AS BIGINT) AS sv_ct FROM pl""", "pl"),
        "st_home_detail_uv": _with("SELECT seq, ts, mid, page_id FROM hd_first", "hd_first"),
        "st_login_back": _with(f"""
SELECT seq, ts, uid, CAST(1 AS BIGINT) AS uu_ct, CAST({_back(7)} AS BIGINT) AS back_ct
FROM login_days""", "login_days"),
        "st_login_back_1d": _with(f"""
SELECT seq, ts, uid, CAST(1 AS BIGINT) AS uu_ct, CAST({_back(1)} AS BIGINT) AS back_ct
FROM login_days""", "login_days"),
        "st_cart_uu": _with("SELECT user_id, ts FROM cart_first", "cart_first"),
        "st_order_uu_new": _with("""
SELECT user_id, ts, CAST(uu_ct AS BIGINT) AS uu_ct, CAST(new_ct AS BIGINT) AS new_ct
FROM order_first""", "order_first"),
        "st_pay_uu_new": _with("""
SELECT user_id, ts, CAST(uu_ct AS BIGINT) AS uu_ct, CAST(new_ct AS BIGINT) AS new_ct
FROM pay_first""", "pay_first"),
        "st_dedup_first": _with("""
SELECT id, ts, sku_id, order_id, province_id, CAST(price AS DOUBLE) AS order_amount FROM once""", "once"),
        "st_delta_correct": _with(f"""
SELECT id, {at} AS et, sku_id, {_dbl(*_SKU_AMOUNTS)} FROM delta""", "delta"),

        # facts
        "dwd_comment": _with("""
SELECT CAST(seq AS VARCHAR) AS id, usr AS user_id, CAST(k AS VARCHAR) AS sku_id, CAST(k % 6 + 1 AS VARCHAR) AS appraise,
       dic.name AS appraise_name, event_type AS comment_txt, ts // 1000 AS ts
FROM ev JOIN dic ON dic.code = CAST(k % 6 + 1 AS VARCHAR) WHERE event_type = 'purchase'""", "ev", "dic"),
        "dwd_trade_cart_add": _with("""
SELECT id, user_id, sku_id, CAST(sku_num AS BIGINT) AS sku_num, ts FROM carts""", "carts"),
        "dwd_trade_order_detail": _with(f"""
SELECT id, {_OD_HEAD}, date_id, create_time, sku_num, {_SPLIT},
       CAST(price AS VARCHAR) AS split_total_amount, ts FROM od""", "od"),
        "dwd_trade_order_cancel": _with(f"""
SELECT od.id, {', '.join('od.' + c for c in _OD_HEAD.split(', '))},
       strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS date_id,
       strftime(o_orderdate + INTERVAL 1 DAY, {DT}) AS cancel_time, sku_num, {_SPLIT},
       CAST(price AS VARCHAR) AS split_total_amount,
       CAST(epoch(o_orderdate + INTERVAL 1 DAY) AS BIGINT) AS ts
FROM od JOIN oc ON oc.order_id = od.order_id WHERE st = 'P'""", "od", "oc"),
        "dwd_trade_pay_suc": _with(f"""
SELECT id AS order_detail_id, {_OD_HEAD}, pri AS payment_type_code, pay_name AS payment_type_name,
       strftime(pt, {DT}) AS callback_time, sku_num, {_SPLIT},
       CAST(price AS VARCHAR) AS split_payment_amount, CAST(epoch(pt) AS BIGINT) AS ts FROM pay""", "pay"),
        "dwd_trade_refund": _with(f"""
SELECT id, user_id, order_id, sku_id, province_id, strftime(l_shipdate, '%Y-%m-%d') AS date_id,
       strftime(l_shipdate, {DT}) AS create_time, pri AS refund_type_code, type_name AS refund_type_name,
       reason AS refund_reason_type_code, reason_name AS refund_reason_type_name, ls AS refund_reason_txt,
       CAST(qty AS VARCHAR) AS refund_num, CAST(price AS VARCHAR) AS refund_amount, ts FROM refunds""", "refunds"),
        "dwd_refund_pay_suc": _with(f"""
SELECT p.id, p.user_id, p.order_id, p.sku_id, p.province_id, p.pri AS payment_type_code,
       dic.name AS payment_type_name, strftime(p.l_shipdate + INTERVAL 1 DAY, '%Y-%m-%d') AS date_id,
       strftime(p.l_shipdate + INTERVAL 1 DAY, {DT}) AS callback_time, CAST(r.qty AS VARCHAR) AS refund_num,
       CAST(p.price AS VARCHAR) AS refund_amount, p.ts + 86400 AS ts
FROM rr p JOIN rr r ON r.order_id = p.order_id AND r.sku_id = p.sku_id AND r.ls = 'F'
JOIN dic ON dic.code = p.pri WHERE p.ls = 'F' AND p.st = 'F'""", "rr", "dic"),

        # aggregates of the user
        "agg_user_count": _with(f"""
SELECT strftime({_win('et', '1 hour')}, {DT}) AS hour, count(*) AS register_ct
FROM ev WHERE event_type = 'signup' GROUP BY {_win('et', '1 hour')}""", "ev"),
        "agg_user_spread": _with("""
SELECT event_type, CAST(k % 10 AS BIGINT) AS last, count(value) AS n, round(avg(value), 6) AS mean,
       round(var_pop(value), 2) AS variance
FROM ev GROUP BY event_type, k % 10""", "ev"),

        # windowed tables
        "dws_traffic": _with("SELECT * FROM traffic", "traffic"),
        "dws_home_detail": _with("SELECT * FROM home_detail", "home_detail"),
        "dws_keyword": _with("SELECT * FROM keyword", "keyword"),
        "dws_user_login": _with("SELECT * FROM login", "login"),
        "dws_user_register": _with("SELECT * FROM register", "register"),
        "dws_cart_uu": _with("SELECT * FROM cart", "cart"),
        "dws_order": _with("SELECT * FROM order_users", "order_users"),
        "dws_payment": _with("SELECT * FROM payment_users", "payment_users"),
        "dws_province_order": _with(f"""
SELECT stt, edt, cur_date, province_id, order_count, {_dbl('order_amount')}, province_name
FROM province""", "province"),
        "dws_refund": _with("SELECT * FROM refund", "refund"),
        "dws_sku_order": _with(f"""
SELECT stt, edt, cur_date, sku_id, {_dbl(*_SKU_AMOUNTS)}, {SKU_COLUMNS} FROM sku_order""", "sku_order"),

        # reports
        "ads_activity": _reduction("activity_reduce_amount", "activity_subsidy_rate"),
        "ads_coupon": _reduction("coupon_reduce_amount", "coupon_subsidy_rate"),
        "ads_trademark": _orders_refunds("trademark_id", "trademark_name"),
        "ads_category": _orders_refunds("category1_id, category2_id, category3_id",
                                        "category1_name, category2_name, category3_name"),
        "ads_trademark_amount": _with("""
SELECT trademark_name, round(CAST(sum(order_amount) AS DOUBLE), 4) AS order_amount
FROM sku_order GROUP BY trademark_id, trademark_name""", "sku_order"),
        "ads_spu": _with("""
SELECT spu_name, round(CAST(sum(order_amount) AS DOUBLE), 4) AS order_amount
FROM sku_order GROUP BY spu_id, spu_name""", "sku_order"),
        "ads_total_amount": _with("""
SELECT round(CAST(sum(order_amount) AS DOUBLE), 4) AS order_total_amount FROM province""", "province"),
        "ads_trade_stats": _with(_labels(
            "type", "value", ("订单数", _sum("order_count", "province")),
            ("下单人数", _sum("order_unique_user_count", "order_users")),
            ("退单数", _sum("refund_count", "refund")),
            ("退单人数", "(SELECT count(DISTINCT user_id) FROM refund)")),
            "province", "order_users", "refund"),
        "ads_province_ct": _with("""
SELECT province_name, CAST(sum(order_count) AS BIGINT) AS order_count FROM province
GROUP BY province_id, province_name""", "province"),
        "ads_province_amount": _with("""
SELECT province_name, round(CAST(sum(order_amount) AS DOUBLE), 4) AS order_amount FROM province
GROUP BY province_id, province_name""", "province"),
        "ads_channel_uv": _channel("CAST(sum(uv_ct) AS BIGINT)", "uv_ct"),
        "ads_channel_sv": _channel("CAST(sum(sv_ct) AS BIGINT)", "sv_ct"),
        "ads_channel_pv_per_session": _channel(_ratio("pv_ct", "sv_ct"), "pv_per_session"),
        "ads_channel_dur_per_session": _channel(_ratio("dur_sum", "sv_ct"), "dur_per_session"),
        "ads_channel_bounce": _channel(_ratio("uj_ct", "sv_ct"), "uj_rate"),
        "ads_keywords": _with("""
SELECT keyword, CAST(sum(keyword_count * CASE source WHEN 'SEARCH' THEN 10 WHEN 'ORDER' THEN 5
       WHEN 'CART' THEN 2 WHEN 'CLICK' THEN 1 ELSE 0 END) AS BIGINT) AS keyword_score
FROM keyword GROUP BY keyword""", "keyword"),
        "ads_visitor_per_hour": _with("""
SELECT lpad(CAST(h.hr AS VARCHAR), 2, '0') AS hr, coalesce(uv, 0) AS uv_ct, coalesce(pv, 0) AS pv_ct,
       coalesce(nuv, 0) AS new_uv_ct
FROM (SELECT unnest(range(24)) AS hr) h
LEFT JOIN (SELECT CAST(substr(stt, 12, 2) AS INTEGER) AS hr, CAST(sum(uv_ct) AS BIGINT) AS uv,
                  CAST(sum(pv_ct) AS BIGINT) AS pv,
                  CAST(sum(CASE WHEN is_new = '1' THEN uv_ct ELSE 0 END) AS BIGINT) AS nuv
           FROM traffic_hour GROUP BY 1) t ON t.hr = h.hr""", "traffic_hour"),
        "ads_visitor_type": _with("""
SELECT is_new, uv_ct, pv_ct, sv_ct, uj_ct, dur_sum, round(uj_rate, 6) AS uj_rate,
       round(avg_dur_sum, 6) AS avg_dur_sum, round(avg_pv_ct, 6) AS avg_pv_ct FROM types""", "types"),
        "ads_visitor_type_pivot": _with(" UNION ALL ".join(
            _pivot_row(n) for n in ("uv_ct", "pv_ct", "uj_rate", "avg_dur_sum", "avg_pv_ct")), "types"),
        "ads_user_change": _with(_labels(
            "type", "user_ct", ("backCt", _sum("back_ct", "login")),
            ("activeUserCt", _sum("uu_ct", "login")),
            ("newUserCt", _sum("register_ct", "register"))), "login", "register"),
        "ads_uv_by_page": _with(_labels(
            "page_id", "uv_ct", ("home", _sum("home_uv_ct", "home_detail")),
            ("good_detail", _sum("good_detail_uv_ct", "home_detail")),
            ("cart", _sum("cart_add_uu_ct", "cart")),
            ("trade", _sum("order_unique_user_count", "order_users")),
            ("payment", _sum("payment_suc_unique_user_count", "payment_users"))),
            "home_detail", "cart", "order_users", "payment_users"),
        "ads_trade_users": _with(_labels(
            "trade_type", "user_ct", ("order", _sum("order_new_user_count", "order_users")),
            ("payment", _sum("payment_suc_new_user_count", "payment_users"))),
            "order_users", "payment_users"),
    }
