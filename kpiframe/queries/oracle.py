"""DuckDB oracle SQL for every registered query, written from the rules of the
report: a current and a previous month joined, one grouped count per category,
per-event ``lag`` sessions. The Spark plans use conditional aggregates, windows
and slot-based sessions instead. Period bounds are written out here. DuckDB
differences handled: ``/ nullif(x, 0)`` for safe division, ``||`` for
NULL-propagating concatenation, casts of ``HUGEINT`` sums back to ``BIGINT``.
"""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace


# ---------------------------------------------------------------------------
# The report's wording, categories, slots and templates, stated
# here again so that the SQL shares nothing with the code it is held against.
# ---------------------------------------------------------------------------
L = SimpleNamespace(
    UP_PREFIX="meningkat sebanyak ",
    DOWN_PREFIX="menurun sebanyak ",
    FLAT_TEXT="Tetap 0%",
    TRAFFIC_FLAT_TEXT="tidak berubah",
    TRAFFIC_NA_TEXT="N/A",
    LIST_SEPARATOR=", ",
    LIST_LAST_SEPARATOR=" dan ",
    SUMMARY_SUFFIX=" mengalami peningkatan dari bulan lalu.",
    SUMMARY_NONE="Tidak ada metrik utama yang mengalami peningkatan dari bulan lalu.",
    METRIC_NAMES=("total visitor", "page view", "engagement rate", "engagement time", "bounce rate"),
)
LABELS = SimpleNamespace(
    products=("BUILDING", "MACHINERY", "HOUSEHOLD"),
    product_suffix={"BUILDING": "building", "MACHINERY": "machinery", "HOUSEHOLD": "household"},
    share_products=("BUILDING", "MACHINERY"),
    excluded_statuses=("1-URGENT", "2-HIGH"),
    open_excluded=("1-URGENT", "2-HIGH", "5-LOW"),
    closed_status="5-LOW",
    document_status="4-NOT SPECIFIED",
    customer_type="O",
    device_arms=(("bundle", ("cumulative_a", "cumulative_b", "cumulative_c")), ("single", ("cumulative_d",))),
    page_view_event="view",
    key_events=("purchase", "signup"),
    property_suffix={"website": "website", "mobile": "mobile", "partner": "partner"},
)
PROPERTIES = ("website", "mobile", "partner")
STATUS_ORDER = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
MONTH_SLOT = "report_month"
USAGE_SLOTS = ("total_customer_building growth_customer_building total_customer_machinery growth_customer_machinery "
               "total_customer_household growth_customer_household").split()
MAU_SLOTS = ("total_mau_building mau_percentage_building growth_mau_building total_mau_machinery mau_percentage_machinery "
             "growth_mau_machinery total_mau_household mau_percentage_household growth_mau_household").split()
ORDER_SLOTS = ("total_orders growth_orders total_completed_orders completed_orders_percentage total_on_progress_orders "
               "on_progress_orders_percentage remaining_order_building remaining_order_machinery remaining_order_regional "
               "total_remaining_order_regional contract_document").split()
VISIT_SLOTS = ("total_visitors_website growth_total_visitors_website summary_website total_visitors_mobile "
               "growth_total_visitors_mobile page_views_mobile growth_page_views_mobile "
               "growth_engagement_rate_mobile").split()
BUNDLE_SLOTS = "total_devices_bundle growth_devices_bundle".split()
PARTNER_SLOTS = ("summary_partner total_visitors_partner growth_total_visitors_partner page_views_partner "
                 "growth_page_views_partner growth_engagement_rate_partner growth_avg_engagement_time_partner").split()
SINGLE_SLOTS = "total_devices_single growth_devices_single".split()
DECK = [MONTH_SLOT, *USAGE_SLOTS, *MAU_SLOTS, *ORDER_SLOTS, *VISIT_SLOTS, *BUNDLE_SLOTS, *PARTNER_SLOTS, *SINGLE_SLOTS]
PLACEHOLDERS = [(i, "{" + slot + "}", slot) for i, slot in enumerate(DECK, 1)]
ORDER_PLACEHOLDERS = [p for p in PLACEHOLDERS if p[2] in (MONTH_SLOT, *ORDER_SLOTS)]


def _listed(slots) -> str:
    return " | ".join("{" + s + "}" for s in slots)


TEMPLATES = [
    ("monthly", "01_title", "Monthly report - {report_month}"),
    ("monthly", "02_customers", "Customers ({report_month}): " + _listed(USAGE_SLOTS)),
    ("monthly", "03_active_users", "Active users: " + _listed(MAU_SLOTS)),
    ("monthly", "04_orders", "Orders: " + _listed(ORDER_SLOTS)),
    ("monthly", "05_traffic", "Traffic: " + _listed(VISIT_SLOTS + PARTNER_SLOTS)),
    ("monthly", "06_devices", "Devices: " + _listed(BUNDLE_SLOTS + SINGLE_SLOTS)),
]
#: Slot names of one property's traffic with the columns they show.
TRAFFIC_SLOTS = [("month", "month_label")] + [(name, name) for name in (
    "total_visitors growth_total_visitors page_views growth_page_views engagement_rate growth_engagement_rate bounce_rate "
    "growth_bounce_rate avg_engagement_time growth_avg_engagement_time summary").split()]
# ---------------------------------------------------------------------------


# ---------------------------------------------------------------------------
# SQL text helpers
# ---------------------------------------------------------------------------
def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def ts(x: dt.date) -> str:
    return f"TIMESTAMP '{x.isoformat()} 00:00:00'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def thousands(x: str) -> str:
    return f"format('{{:t.}}', {x})"


def fixed2(x: str) -> str:
    return f"printf('%.2f', {x})"


def percent2(x: str) -> str:
    return f"({fixed2(x)} || '%')"


def mean(x: str) -> str:
    """Mean of fractions cut to whole numbers of 2**-52, which add up exactly."""
    unit = "4503599627370496::DOUBLE"
    return f"CAST(sum(CAST(floor({x} * {unit}) AS BIGINT)) AS DOUBLE) / (count({x}) * {unit})"


def growth(cur: str, prev: str) -> str:
    return f"(({cur}) - ({prev})) / nullif({prev}, 0) * 100"


def phrase(g: str, style: str) -> str:
    num = {
        "cast": lambda x: f"regexp_replace({fixed2(x)}, '[.]?0+$', '')",
        "fixed2": fixed2,
        "float": lambda x: f"regexp_replace({fixed2(x)}, '0$', '')",
    }[style]
    return (
        f"CASE WHEN {g} > 0 THEN {q(L.UP_PREFIX)} || {num(g)} || '%' "
        f"WHEN {g} < 0 THEN {q(L.DOWN_PREFIX)} || {num(f'abs({g})')} || '%' "
        f"ELSE {q(L.FLAT_TEXT)} END"
    )


def phrase_traffic(cur: str, prev: str) -> str:
    g = growth(cur, prev)
    return (
        f"CASE WHEN {prev} IS NULL OR {cur} IS NULL THEN NULL "
        f"WHEN {prev} = 0 THEN {q(L.TRAFFIC_NA_TEXT)} "
        f"WHEN {g} > 0 THEN {q(L.UP_PREFIX)} || {fixed2(g)} || '%' "
        f"WHEN {g} < 0 THEN {q(L.DOWN_PREFIX)} || {fixed2(g)} || '%' "
        f"ELSE {q(L.TRAFFIC_FLAT_TEXT)} END"
    )


def join_list(lst: str) -> str:
    return (
        f"CASE WHEN len({lst}) = 1 THEN {lst}[1] "
        f"WHEN len({lst}) > 1 THEN array_to_string({lst}[1:len({lst}) - 1], {q(L.LIST_SEPARATOR)}) "
        f"|| {q(L.LIST_LAST_SEPARATOR)} || {lst}[len({lst})] END"
    )


def flagged(pairs) -> str:
    items = ", ".join(f"CASE WHEN {cond} THEN {q(name)} END" for cond, name in pairs)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def month_of(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


def values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


# ---------------------------------------------------------------------------
# Source views (same derivations as kpiframe.sources.mapped)
# ---------------------------------------------------------------------------
P = SimpleNamespace(previous_start=dt.date(2001, 6, 1), current_start=dt.date(2001, 7, 1), current_end=dt.date(2001, 8, 1))
T = SimpleNamespace(previous_start=dt.date(2024, 1, 8), current_start=dt.date(2024, 1, 15), current_end=dt.date(2024, 1, 22))
PROD = in_list(LABELS.products)
SHARE = in_list(LABELS.share_products)
EXCL = in_list(LABELS.excluded_statuses)
NOT_OPEN = in_list(LABELS.open_excluded)

_PROPERTY_CASE = "CASE " + " ".join(
    f"WHEN user_id % {len(PROPERTIES)} = {i} THEN {q(p)}" for i, p in enumerate(PROPERTIES)
) + " END"

def _monthly_usage(by: str = "") -> str:
    return f"""
  SELECT {by}c.c_mktsegment AS product, {month_of('o.o_orderdate')} AS month, o.o_orderpriority AS tier,
         CAST(count(DISTINCT o.o_custkey) AS BIGINT) AS total_customer,
         CAST(count(DISTINCT o.o_custkey) FILTER (WHERE o.o_orderstatus = 'F') AS BIGINT) AS mau,
         CAST(count(DISTINCT o.o_custkey) FILTER (WHERE o.o_orderstatus = 'F') AS DOUBLE)
           / CAST(count(DISTINCT o.o_custkey) AS DOUBLE) AS ratio
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY ALL"""


VIEWS: dict[str, str] = {
    "monthly_usage": _monthly_usage(),
    "monthly_usage_n": _monthly_usage("n.n_name AS nation, "),
    "orders_flat": """
  SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_created_date,
         o.o_orderpriority AS fulfillment_status, c.c_mktsegment AS product, r.r_name AS regional,
         n.n_name AS nation
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "orders_plain": """
  SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_created_date, o_orderpriority AS fulfillment_status
  FROM orders""",
    "daily_metrics": """
  SELECT date, customer_type,
         CAST(sum(a) OVER w AS BIGINT) AS cumulative_a, CAST(sum(b) OVER w AS BIGINT) AS cumulative_b,
         CAST(sum(c) OVER w AS BIGINT) AS cumulative_c, CAST(sum(d) OVER w AS BIGINT) AS cumulative_d
  FROM (SELECT CAST(l_shipdate AS DATE) AS date, l_linestatus AS customer_type,
               count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'R') AS b,
               count(*) FILTER (WHERE l_returnflag = 'N') AS c, count(*) FILTER (WHERE l_linenumber = 1) AS d
        FROM lineitem GROUP BY ALL) daily
  WINDOW w AS (PARTITION BY customer_type ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "traffic_events": f"""
  SELECT event_id, ts, user_id, event_type, {_PROPERTY_CASE} AS property FROM events""",
}


# ---------------------------------------------------------------------------
# Report layers
# ---------------------------------------------------------------------------
LAYERS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def layer(name: str, deps: list[str], sql: str) -> None:
    LAYERS[name] = sql
    DEPS[name] = deps


def _two_months(source: str, month: str, keys: str, measures: str, where: str) -> str:
    """One aggregate per month, the previous one joined to the current one."""
    def one(day) -> str:
        return (f"SELECT {keys}, {measures} FROM {source} WHERE {month} = {d(day)} AND {where} GROUP BY {keys}")

    return f"({one(P.current_start)}) now LEFT JOIN ({one(P.previous_start)}) old USING ({keys})"


def _grown(now: str, old: str) -> str:
    return f"round({growth(now, old)}, 2)"


def _usage(measure: str, name: str, also: str = "", also_out: str = "", also_text: str = "",
           source: str = "monthly_usage", by: str = "") -> str:
    """Growth of a summed usage measure per product (and ``by``: a key with a comma after it)."""
    tables = _two_months(source, "month", f"{by}product", f"CAST(sum({measure}) AS BIGINT) AS n{also}", f"product IN {PROD}")
    return f"""
  SELECT {by}product, {d(P.current_start)} AS month, n AS {name}, n_old AS prev_{name}{also_out}, growth_pct,
         {thousands('n')} AS {name}_text{also_text}, {phrase('growth_pct', 'cast')} AS growth_phrase
  FROM (SELECT {by}product, now.n, old.n AS n_old{', now.share' if also else ''}, {_grown('now.n', 'old.n')} AS growth_pct FROM {tables})"""


layer("k1", ["monthly_usage"], _usage("total_customer", "total_customer"))
_MAU = ("mau", "total_mau", f", {mean('ratio')} AS share", ", share AS mau_percentage",
        f", {percent2('share * 100')} AS mau_percentage_text")
layer("k2", ["monthly_usage"], _usage(*_MAU))
layer("k1n", ["monthly_usage_n"], _usage("total_customer", "total_customer", source="monthly_usage_n", by="nation, "))
layer("k2n", ["monthly_usage_n"], _usage(*_MAU, source="monthly_usage_n", by="nation, "))

_MONTH = month_of("order_created_date")
_COUNTED = f"fulfillment_status NOT IN {EXCL}"

def _progress(orders: str, by: str = "") -> str:
    """K3 over ``orders`` (for every ``by``: a key with a comma after it)."""
    group = f"GROUP BY {by[:-2]}" if by else ""
    return f"""
  SELECT {by}{d(P.current_start)} AS order_month, n AS total_orders, done AS total_completed, going AS total_on_progress,
         n_old AS prev_total_orders, growth_pct, completed_pct, on_progress_pct,
         {thousands('n')} AS total_orders_text, {thousands('done')} AS total_completed_text,
         {thousands('going')} AS total_on_progress_text, {phrase('growth_pct', 'fixed2')} AS growth_phrase,
         {percent2('growth_pct')} AS growth_pct_text, {percent2('completed_pct')} AS completed_pct_text,
         {percent2('on_progress_pct')} AS on_progress_pct_text
  FROM (SELECT *, {_grown('n', 'n_old')} AS growth_pct, round(done::DOUBLE / nullif(n, 0) * 100, 2) AS completed_pct,
               round(going::DOUBLE / nullif(n, 0) * 100, 2) AS on_progress_pct
        FROM (SELECT {by}count(order_id) FILTER ({_MONTH} = {d(P.current_start)} AND {_COUNTED}) AS n,
                     count(*) FILTER ({_MONTH} = {d(P.current_start)} AND {_COUNTED}) AS n_rows,
                     nullif(count(order_id) FILTER ({_MONTH} = {d(P.previous_start)} AND {_COUNTED}), 0) AS n_old,
                     count(*) FILTER ({_MONTH} = {d(P.current_start)} AND {_COUNTED}
                                      AND fulfillment_status = {q(LABELS.closed_status)}) AS done,
                     count(*) FILTER ({_MONTH} = {d(P.current_start)} AND {_COUNTED}
                                      AND fulfillment_status NOT IN {NOT_OPEN}) AS going
              FROM {orders} {group}))
  WHERE n_rows > 0"""


layer("k3", ["orders_flat"], _progress("orders_flat"))
layer("k3_alone", ["orders_plain"], _progress("orders_plain"))


def _categories(by: str) -> str:
    """K4 from one grouped count; ``by``: '' or a key with a comma after it."""
    part = f"PARTITION BY {by[:-2]}" if by else ""
    return f"""
  WITH cube AS (
    SELECT {by}fulfillment_status AS status, product, regional, count(*) AS n
    FROM orders_flat WHERE {_MONTH} = {d(P.current_start)} GROUP BY ALL),
  arms AS (
    SELECT {by}'status' AS category, status AS label, sum(n) AS n FROM cube
    WHERE status = {q(LABELS.document_status)} GROUP BY ALL
    UNION ALL
    SELECT {by}'product', product, sum(n) FROM cube
    WHERE status NOT IN {NOT_OPEN} AND product IN {SHARE} GROUP BY ALL
    UNION ALL
    SELECT {by}'regional', regional, sum(n) FROM cube WHERE status NOT IN {NOT_OPEN} GROUP BY ALL)
  SELECT {by}category, label, CAST(CAST(n AS BIGINT) AS VARCHAR) AS total_orders,
         CASE WHEN category = 'product' THEN
           {fixed2(f"CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY {by}category) AS DOUBLE) * 100")} END AS percentage
  FROM arms
  QUALIFY category <> 'regional'
    OR row_number() OVER (PARTITION BY {by}category ORDER BY n DESC, label ASC NULLS LAST) = 1"""


layer("k4", ["orders_flat"], _categories(""))

_TOPS = ", ".join(f"max(cumulative_{c}) AS {c}" for c in "abcd")
_ARMS = " UNION ALL ".join(
    f"SELECT {q(name)} AS product_type, " + " + ".join(f"now.{c[-1]}" for c in cols) + " AS n, "
    + " + ".join(f"old.{c[-1]}" for c in cols) + " AS n_old FROM "
    + _two_months("daily_metrics", month_of("date"), "customer_type", _TOPS, f"customer_type = {q(LABELS.customer_type)}")
    for name, cols in LABELS.device_arms)
layer("k5", ["daily_metrics"], f"""
  SELECT product_type, {d(P.current_start)} AS month, CAST(n AS BIGINT) AS total_devices,
         CAST(n_old AS BIGINT) AS prev_total_devices, growth_pct, {thousands('n')} AS total_devices_text,
         {phrase('growth_pct', 'float')} AS growth_phrase
  FROM (SELECT *, {_grown('n', 'n_old')} AS growth_pct FROM ({_ARMS}))""")

layer("k6", ["traffic_events"], f"""
  WITH pe AS (
    SELECT property, user_id, ts, event_type,
           CASE WHEN ts >= {ts(T.current_start)} THEN 'current' ELSE 'previous' END AS period
    FROM traffic_events WHERE ts >= {ts(T.previous_start)} AND ts < {ts(T.current_end)}),
  g AS (
    SELECT *, CASE WHEN lag(ts) OVER w IS NULL
                     OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 30 * 60 * 1000000 THEN 1 ELSE 0 END AS new_s
    FROM pe WINDOW w AS (PARTITION BY property, period, user_id ORDER BY ts)),
  s AS (
    SELECT *, sum(new_s) OVER (PARTITION BY property, period, user_id ORDER BY ts
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
    FROM g),
  ss AS (
    SELECT property, period, user_id, sid, epoch_us(max(ts)) - epoch_us(min(ts)) AS dur_us,
           count(*) FILTER (WHERE event_type = {q(LABELS.page_view_event)}) AS views,
           count(*) FILTER (WHERE event_type IN {in_list(LABELS.key_events)}) AS key_events
    FROM s GROUP BY ALL),
  agg AS (
    SELECT property, period,
           CAST(count(DISTINCT user_id) AS BIGINT) AS total_users, CAST(sum(views) AS BIGINT) AS page_views,
           CAST(count(*) AS BIGINT) AS sessions,
           CAST(count(*) FILTER (WHERE dur_us > 10 * 1000000 OR views >= 2 OR key_events >= 1) AS BIGINT)
             AS engaged_sessions,
           CAST(sum(dur_us) AS DOUBLE) AS sum_dur
    FROM ss GROUP BY ALL)
  SELECT property, period,
         CASE WHEN period = 'current' THEN {d(T.current_start)} ELSE {d(T.previous_start)} END AS period_start,
         total_users, page_views, sessions, engaged_sessions,
         CAST(engaged_sessions AS DOUBLE) / CAST(sessions AS DOUBLE) AS engagement_rate,
         CAST(1.0 AS DOUBLE) - CAST(engaged_sessions AS DOUBLE) / CAST(sessions AS DOUBLE) AS bounce_rate,
         sum_dur / CAST(sessions AS DOUBLE) / CAST(1000000 AS DOUBLE) AS avg_session_duration
  FROM agg""")

_metric_cols = (("users", "total_users"), ("views", "page_views"), ("eng", "engagement_rate"),
                ("dur", "avg_session_duration"), ("bounce", "bounce_rate"))
_k7_text = {
    "total_visitors": thousands("c.total_users"),
    "growth_total_visitors": phrase_traffic("c.total_users", "p.total_users"),
    "page_views": thousands("c.page_views"),
    "growth_page_views": phrase_traffic("c.page_views", "p.page_views"),
    "engagement_rate": fixed2("c.engagement_rate"),
    "growth_engagement_rate": phrase_traffic("c.engagement_rate", "p.engagement_rate"),
    "bounce_rate": fixed2("c.bounce_rate"),
    "growth_bounce_rate": phrase_traffic("c.bounce_rate", "p.bounce_rate"),
    "avg_engagement_time": fixed2("c.avg_session_duration"),
    "growth_avg_engagement_time": phrase_traffic("c.avg_session_duration", "p.avg_session_duration"),
}
layer("k7", ["k6"], f"""
  SELECT c.property, strftime({d(T.current_start)}, '%B %Y') AS month_label,
         {', '.join(f'{sql} AS {name}' for name, sql in _k7_text.items())},
         {', '.join(f'c.{col} AS cur_{k}, p.{col} AS prev_{k}' for k, col in _metric_cols)}
  FROM k6 c JOIN k6 p ON c.property = p.property AND c.period = 'current' AND p.period = 'previous'""")

_improved = flagged([(f"cur_{k} > prev_{k}", name) for (k, _), name in zip(_metric_cols, L.METRIC_NAMES, strict=True)])
layer("k8", ["k7"], f"""
  SELECT *, len(improved) AS n_improved,
         CASE WHEN len(improved) > 0 THEN {join_list('improved')} || {q(L.SUMMARY_SUFFIX)}
              ELSE {q(L.SUMMARY_NONE)} END AS summary
  FROM (SELECT *, {_improved} AS improved FROM k7)""")

_prop_sfx = values(sorted(LABELS.property_suffix.items()), ["label", "suffix"])
layer("k9", ["k8"], "\n  UNION ALL\n".join(
    f"  SELECT {q(name + '_')} || s.suffix AS slot, k8.{col} AS value FROM k8 JOIN {_prop_sfx} s ON k8.property = s.label"
    for name, col in TRAFFIC_SLOTS
))

_prod_sfx = values(sorted(LABELS.product_suffix.items()), ["label", "suffix"])
_share_sfx = values(sorted((p, LABELS.product_suffix[p]) for p in LABELS.share_products),
                    ["label", "suffix"])
_arm_sfx = values([(n, n) for n, _ in LABELS.device_arms], ["label", "suffix"])


def _suffixed(src: str, key: str, table: str, names) -> list[str]:
    return [f"SELECT {q(n + '_')} || s.suffix AS slot, x.{c} AS value FROM {src} x JOIN {table} s ON x.{key} = s.label"
            for n, c in names]


_slot_parts = [f"SELECT {q(MONTH_SLOT)} AS slot, strftime({d(P.current_start)}, '%B %Y') AS value"]
_slot_parts += _suffixed("k1", "product", _prod_sfx, [("total_customer", "total_customer_text"),
                                                      ("growth_customer", "growth_phrase")])
_slot_parts += _suffixed("k2", "product", _prod_sfx, [("total_mau", "total_mau_text"),
                                                      ("mau_percentage", "mau_percentage_text"),
                                                      ("growth_mau", "growth_phrase")])
_slot_parts += [f"SELECT {q(n)}, {c} FROM k3" for n, c in [
    ("total_orders", "total_orders_text"), ("growth_orders", "growth_phrase"),
    ("total_completed_orders", "total_completed_text"), ("completed_orders_percentage", "completed_pct_text"),
    ("total_on_progress_orders", "total_on_progress_text"), ("on_progress_orders_percentage", "on_progress_pct_text"),
]]
_slot_parts += ["SELECT 'contract_document', total_orders FROM k4 WHERE category = 'status'"]
_slot_parts += _suffixed("(SELECT * FROM k4 WHERE category = 'product')", "label", _share_sfx,
                         [("remaining_order", "total_orders")])
_slot_parts += ["SELECT 'remaining_order_regional', label FROM k4 WHERE category = 'regional'",
                "SELECT 'total_remaining_order_regional', total_orders FROM k4 WHERE category = 'regional'"]
_slot_parts += _suffixed("k5", "product_type", _arm_sfx, [("total_devices", "total_devices_text"),
                                                          ("growth_devices", "growth_phrase")])
_slot_parts += ["SELECT slot, value FROM k9"]
layer("slots", ["k1", "k2", "k3", "k4", "k5", "k9"],
      f"  SELECT {q(P.current_start.isoformat())} AS report_id, {d(P.current_start)} AS report_month, slot, value FROM (\n    "
      + "\n    UNION ALL ".join(_slot_parts) + ")")

layer("placeholders", [], "  SELECT * FROM " + values(PLACEHOLDERS, ["ord", "placeholder", "slot"]))
layer("binding", ["slots", "placeholders"], """
  SELECT r.report_id, r.report_month, p.ord, p.placeholder, p.slot, s.value
  FROM (SELECT DISTINCT report_id, report_month FROM slots) r CROSS JOIN placeholders p
  LEFT JOIN slots s ON s.report_id = r.report_id AND s.slot = p.slot""")


def _render_sql() -> str:
    text = "t.text"
    for _, ph, slot in PLACEHOLDERS:
        val = f"(SELECT value FROM slots WHERE slot = {q(slot)})"
        text = f"replace({text}, {q(ph)}, coalesce({val}, {q(ph)}))"
    templates = values(TEMPLATES, ["deck_id", "template_id", "text"])
    return (f"  SELECT r.report_id, r.report_month, t.deck_id, t.template_id, {text} AS text\n"
            f"  FROM (SELECT DISTINCT report_id, report_month FROM slots) r CROSS JOIN {templates} t")


layer("render", ["slots"], _render_sql())

# Reports per nation (K1-K4 grouped by nation).
layer("k3n", ["orders_flat"], _progress("orders_flat", "nation, "))
layer("k4n", ["orders_flat"], _categories("nation, "))
_K3_SLOTS = ["total_orders", "growth_orders", "total_completed_orders", "completed_orders_percentage",
             "total_on_progress_orders", "on_progress_orders_percentage"]
layer("slots_n", ["k3n", "k4n"], f"""
  SELECT {q(P.current_start.isoformat() + '/')} || nation AS report_id, {d(P.current_start)} AS report_month, slot, value FROM (
    SELECT nation, 'report_month' AS slot, strftime({d(P.current_start)}, '%B %Y') AS value
    FROM (SELECT nation FROM k3n UNION SELECT nation FROM k4n)
    UNION ALL SELECT nation, unnest([{', '.join(map(q, _K3_SLOTS))}]), unnest([total_orders_text, growth_phrase,
      total_completed_text, completed_pct_text, total_on_progress_text, on_progress_pct_text]) FROM k3n
    UNION ALL SELECT nation, 'contract_document', total_orders FROM k4n WHERE category = 'status'
    UNION ALL SELECT k.nation, 'remaining_order_' || s.suffix, k.total_orders
              FROM k4n k JOIN {_share_sfx} s ON k.label = s.label WHERE k.category = 'product'
    UNION ALL SELECT nation, 'remaining_order_regional', label FROM k4n WHERE category = 'regional'
    UNION ALL SELECT nation, 'total_remaining_order_regional', total_orders FROM k4n WHERE category = 'regional')""")
_NATION_SLOTS = ["report_month", "remaining_order_building", "remaining_order_machinery", "remaining_order_regional"]
_NATION_TEXT = ("{report_month}: {remaining_order_building} building, {remaining_order_machinery} machinery, "
                "most in {remaining_order_regional}")


def _nation_render() -> str:
    text = q(_NATION_TEXT)
    for slot in _NATION_SLOTS:
        ph = q("{" + slot + "}")
        text = f"replace({text}, {ph}, coalesce(max(value) FILTER (slot = {q(slot)}), {ph}))"
    return (f"  SELECT report_id, report_month, 'monthly' AS deck_id, 'orders' AS template_id, {text} AS text FROM slots_n "
            "GROUP BY report_id, report_month")


layer("render_n", ["slots_n"], _nation_render())

# The whole deck of every nation: its own slots, and the shared ones of the
# whole report (devices and traffic).
_OWN_PARTS = [f"SELECT nation, {q(n + '_')} || s.suffix AS slot, x.{c} AS value FROM {src} x JOIN {_prod_sfx} s ON x.product = s.label"
              for src, pairs in (("k1n", [("total_customer", "total_customer_text"), ("growth_customer", "growth_phrase")]),
                                 ("k2n", [("total_mau", "total_mau_text"), ("mau_percentage", "mau_percentage_text"),
                                          ("growth_mau", "growth_phrase")])) for n, c in pairs]
_SHARED_PARTS = _suffixed("k5", "product_type", _arm_sfx, [("total_devices", "total_devices_text"),
                                                           ("growth_devices", "growth_phrase")])
_SHARED_PARTS += ["SELECT slot, value FROM k9",
                  f"SELECT {q(MONTH_SLOT)}, strftime({d(P.current_start)}, '%B %Y')"]
layer("deck_n", ["slots_n", "k1n", "k2n", "k5", "k9"], f"""
  SELECT report_id, slot, value FROM slots_n WHERE slot <> {q(MONTH_SLOT)}
  UNION ALL
  SELECT {q(P.current_start.isoformat() + '/')} || nation, slot, value FROM (
    {" UNION ALL ".join(_OWN_PARTS)})
  UNION ALL
  SELECT {q(P.current_start.isoformat() + '/')} || n.n_name, slot, value
  FROM nation n CROSS JOIN ({" UNION ALL ".join(_SHARED_PARTS)})""")


def _deck_render() -> str:
    text = "t.text"
    for _, ph, slot in PLACEHOLDERS:
        text = f"replace({text}, {q(ph)}, coalesce(v[{q(slot)}], {q(ph)}))"
    templates = values(TEMPLATES, ["deck_id", "template_id", "text"])
    return f"""
  SELECT report_id, {d(P.current_start)} AS report_month, t.deck_id, t.template_id, {text} AS text
  FROM (SELECT report_id, map(list(slot), list(value)) AS v FROM deck_n GROUP BY report_id) r CROSS JOIN {templates} t"""


layer("deck_render_n", ["deck_n"], _deck_render())

# Hourly traffic as text: '(not set)' without a denominator, '--' without views.
layer("text_export", ["traffic_events"], """
  SELECT property, date_trunc('hour', ts) AS hour, count(DISTINCT user_id) AS total_users,
         nullif(count(*) FILTER (event_type = 'view'), 0) AS page_views,
         (count(*) FILTER (event_type = 'purchase'))::DOUBLE / nullif(count(*) FILTER (event_type = 'signup'), 0)
           AS engagement_rate, (count(*) FILTER (event_type = 'error'))::VARCHAR AS errors
  FROM traffic_events GROUP BY ALL""")


def compose(final: str, deps: list[str]) -> str:
    """``WITH`` clause holding every view/layer ``final`` needs, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in DEPS.get(n, []):
            visit(dep)
        order.append(n)

    for n in deps:
        visit(n)
    ctes = [f"{n} AS ({VIEWS[n] if n in VIEWS else LAYERS[n]}\n)" for n in order]
    return "WITH " + ",\n".join(ctes) + "\n" + final


# ---------------------------------------------------------------------------
# Registered queries
# ---------------------------------------------------------------------------
def _month_orders() -> str:
    return f"SELECT *, {month_of('order_created_date')} AS order_month FROM orders_plain"


def _product_months() -> str:
    return ("SELECT product, month, CAST(sum(total_customer) AS BIGINT) AS total_customer, "
            "CAST(lag(sum(total_customer)) OVER (PARTITION BY product ORDER BY month) AS BIGINT) "
            "AS prev_total_customer FROM monthly_usage GROUP BY product, month")


def _order_months() -> str:
    return (f"SELECT order_month, count(order_id) AS total_orders, "
            f"lag(count(order_id)) OVER (ORDER BY order_month) AS prev_total_orders "
            f"FROM ({_month_orders()}) GROUP BY order_month")


def _closed_share() -> str:
    return (f"SELECT order_month, count(*) FILTER (WHERE fulfillment_status = {q(LABELS.closed_status)}) AS n_closed, "
            f"count(*) AS n_rows FROM ({_month_orders()}) GROUP BY order_month")


_K7_COLS = ["property"] + [col for _, col in TRAFFIC_SLOTS if col != "summary"]

ORACLE: dict[str, str] = {
    # pipelines
    "customer_growth": compose("SELECT * FROM k1", ["k1"]),
    "customer_growth_ranked": compose(
        "SELECT *, (SELECT count(*) FROM k1 x WHERE x.product <= k1.product)::INTEGER AS pos FROM k1", ["k1"]),
    "mau_growth": compose("SELECT * FROM k2", ["k2"]),
    "order_progress": compose("SELECT * FROM k3_alone", ["k3_alone"]),
    "order_category": compose("SELECT * FROM k4", ["k4"]),
    "device_growth": compose("SELECT * FROM k5", ["k5"]),
    "device_growth_incremental": compose("SELECT * FROM k5", ["k5"]),
    "usage_bucketed": compose(
        "SELECT product, month, tier, total_customer, mau FROM monthly_usage "
        f"WHERE month IN ({d(P.previous_start)}, {d(P.current_start)})", ["monthly_usage"]),
    "approx_users": compose("SELECT property, period, total_users, true AS within_bound FROM k6", ["k6"]),
    "traffic_from_text": compose(
        "SELECT property, strftime(hour, '%Y-%m-%d %H') AS period, hour::DATE AS period_start, total_users, page_views, "
        "engagement_rate, 4::BIGINT AS n_values, (1 + (page_views IS NULL)::INT + (engagement_rate IS NULL)::INT)::BIGINT "
        "AS n_rejected FROM text_export", ["text_export"]),
    "traffic_rejects": compose(
        "SELECT property, 'page_views' AS metric, '--' AS value, count(*) AS n FROM text_export "
        "WHERE page_views IS NULL GROUP BY property UNION ALL "
        "SELECT property, 'engagement_rate', '(not set)', count(*) FROM text_export "
        "WHERE engagement_rate IS NULL GROUP BY property UNION ALL "
        "SELECT property, 'errors', errors, count(*) FROM text_export GROUP BY property, errors", ["text_export"]),
    "traffic_metrics": compose("SELECT * FROM k6", ["k6"]),
    "traffic_growth": compose(f"SELECT {', '.join(_K7_COLS)} FROM k7", ["k7"]),
    "traffic_summary": compose("SELECT property, CAST(n_improved AS INTEGER) AS n_improved, summary FROM k8", ["k8"]),
    "traffic_all": compose("SELECT slot, value FROM k9", ["k9"]),
    "report_slots": compose("SELECT * EXCLUDE (report_month) FROM slots", ["slots"]),
    "slot_binding": compose("SELECT * EXCLUDE (report_month) FROM binding", ["binding"]),
    "slot_missing": compose(
        "SELECT report_id, ord, placeholder, slot FROM binding WHERE value IS NULL UNION ALL "
        "SELECT DISTINCT report_id, 47, '{remaining_order_household}', 'remaining_order_household' FROM slots",
        ["binding", "slots"]),
    "slot_merge": compose(
        f"SELECT {q(P.current_start.isoformat())} AS report_id, {d(P.current_start)} AS report_month, slot, value FROM ("
        f"SELECT 'orders_' || lower(product) AS slot, CASE WHEN product IN {SHARE} THEN sum(n)::BIGINT::VARCHAR "
        "ELSE arg_max(status || ' ' || n, status) END AS value FROM ("
        "SELECT product, fulfillment_status AS status, count(*) AS n FROM orders_flat GROUP BY ALL) GROUP BY product "
        f"UNION ALL SELECT 'report_month', strftime({d(P.current_start)}, '%B %Y'))", ["orders_flat"]),
    "report_sink": (
        f"SELECT 'orders' AS report_id, {month_of('o_orderdate')} AS report_month, 'monthly' AS deck_id, "
        f"'orders' AS template_id, strftime({month_of('o_orderdate')}, '%B %Y') || ': ' || {thousands('count(o_orderkey)')} "
        f"|| ' orders' AS text FROM orders WHERE o_orderpriority NOT IN {EXCL} "
        f"AND {month_of('o_orderdate')} IN ({d(P.previous_start)}, {d(P.current_start)}) GROUP BY {month_of('o_orderdate')}"),
    "report_render_deck_by_nation": compose("SELECT * FROM deck_render_n", ["deck_render_n"]),
    "report_render": compose("SELECT * EXCLUDE (report_month) FROM render", ["render"]),
    "slot_missing_by_nation": compose(
        "SELECT r.report_id, p.ord, p.placeholder, p.slot FROM (SELECT DISTINCT report_id FROM slots_n) r "
        "CROSS JOIN " + values(ORDER_PLACEHOLDERS, ["ord", "placeholder", "slot"]) + " p "
        "WHERE NOT EXISTS (SELECT 1 FROM slots_n s WHERE s.report_id = r.report_id AND s.slot = p.slot)",
        ["slots_n"]),
    "report_render_by_nation": compose("SELECT * EXCLUDE (report_month) FROM render_n", ["render_n"]),
    # primitives
    "pred_in": compose(f"SELECT order_id, product FROM orders_flat WHERE product IN {PROD}", ["orders_flat"]),
    "pred_month_exact": compose(
        f"SELECT product, month, tier, total_customer, mau FROM monthly_usage WHERE product IN {PROD} "
        f"AND month IN ({d(P.previous_start)}, {d(P.current_start)})", ["monthly_usage"]),
    "pred_month_range": (
        f"SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_created_date, "
        f"o_orderpriority AS fulfillment_status FROM orders "
        f"WHERE {month_of('o_orderdate')} IN ({d(P.previous_start)}, {d(P.current_start)})"),
    "pred_not_in_null": compose(
        f"SELECT order_id, fulfillment_status FROM orders_plain WHERE fulfillment_status NOT IN {EXCL}",
        ["orders_plain"]),
    "period_bounds": f"""
      SELECT as_of,
             CAST(date_trunc('month', as_of) - INTERVAL 2 MONTH AS DATE) AS previous_start,
             CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS previous_last_day,
             CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE) AS current_start,
             CAST(date_trunc('month', as_of) - INTERVAL 1 DAY AS DATE) AS current_last_day,
             CAST(date_trunc('month', as_of) AS DATE) AS current_end,
             strftime(CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE), '%Y-%m-%d') AS current_start_text,
             strftime(CAST(date_trunc('month', as_of) - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS current_last_day_text
      FROM (SELECT DISTINCT {month_of('o_orderdate')} + 14 AS as_of FROM orders)""",
    "lookup_suffix": compose(
        f"SELECT o.product, s.suffix, count(*) AS n_orders FROM orders_flat o JOIN {_prod_sfx} s "
        f"ON o.product = s.label GROUP BY o.product, s.suffix", ["orders_flat"]),
    "agg_sum_avg": compose(
        "SELECT product, month, CAST(sum(total_customer) AS BIGINT) AS total_customer, "
        f"CAST(sum(mau) AS BIGINT) AS total_mau, {mean('ratio')} AS avg_ratio "
        "FROM monthly_usage GROUP BY product, month", ["monthly_usage"]),
    "agg_counts": compose(
        f"SELECT order_month, count(order_id) AS n_ids, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE fulfillment_status = {q(LABELS.closed_status)}) AS n_closed "
        f"FROM ({_month_orders()}) GROUP BY order_month", ["orders_plain"]),
    "agg_max_sum": compose(
        f"SELECT customer_type, {month_of('date')} AS month, "
        f"max(cumulative_a) + max(cumulative_b) + max(cumulative_c) AS total_abc, max(cumulative_d) AS total_d "
        f"FROM daily_metrics GROUP BY 1, 2", ["daily_metrics"]),
    "win_lag_partitioned": compose(_product_months(), ["monthly_usage"]),
    "win_lag_global": compose(_order_months(), ["orders_plain"]),
    "win_share_of_total": compose(
        "SELECT product, count(*) AS n, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100 "
        "AS share FROM orders_flat GROUP BY product", ["orders_flat"]),
    "topk_region": compose(
        f"SELECT regional, count(*) AS n FROM orders_flat WHERE fulfillment_status NOT IN {NOT_OPEN} "
        f"GROUP BY regional ORDER BY n DESC, regional ASC NULLS LAST LIMIT 1", ["orders_flat"]),
    "union_typed_null": compose(
        "SELECT 'status' AS category, fulfillment_status AS label, CAST(count(*) AS VARCHAR) AS total_orders, "
        "CAST(NULL AS VARCHAR) AS percentage FROM orders_flat GROUP BY fulfillment_status "
        "UNION ALL "
        "SELECT 'product', product, CAST(count(*) AS VARCHAR), "
        + fixed2("CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100")
        + " FROM orders_flat GROUP BY product", ["orders_flat"]),
    "fn_month_trunc": f"SELECT {month_of('o_orderdate')} AS month, count(*) AS n FROM orders GROUP BY 1",
    "fn_round2": compose(
        f"SELECT order_month, round(CAST(n_closed AS DOUBLE) / nullif(n_rows, 0) * 100, 2) AS completed_pct "
        f"FROM ({_closed_share()})", ["orders_plain"]),
    "fn_growth_pct": compose(
        f"SELECT product, month, {growth('total_customer', 'prev_total_customer')} AS growth_pct "
        f"FROM ({_product_months()})", ["monthly_usage"]),
    "fn_safe_divide": compose(
        f"SELECT order_created_date, CAST(count(*) FILTER (WHERE fulfillment_status = {q(LABELS.closed_status)}) "
        f"AS DOUBLE) / nullif(count(*) FILTER (WHERE fulfillment_status = '1-URGENT'), 0) AS closed_per_urgent "
        f"FROM orders_plain GROUP BY order_created_date", ["orders_plain"]),
    "fn_month_label": (
        f"SELECT DISTINCT {month_of('o_orderdate')} AS month, strftime({month_of('o_orderdate')}, '%B %Y') AS label "
        f"FROM orders"),
    "fn_list_join": compose(
        "SELECT order_month, CAST(len(l) AS INTEGER) AS n_grown, " + join_list("l") + " AS grown_text FROM ("
        "SELECT order_month, " + flagged([(f"s{i} > prev_s{i}", s) for i, s in enumerate(STATUS_ORDER)])
        + " AS l FROM (SELECT order_month, "
        + ", ".join(f"s{i}, lag(s{i}) OVER (ORDER BY order_month) AS prev_s{i}" for i in range(len(STATUS_ORDER)))
        + " FROM (SELECT order_month, "
        + ", ".join(f"count(*) FILTER (WHERE fulfillment_status = {q(s)}) AS s{i}" for i, s in enumerate(STATUS_ORDER))
        + f" FROM ({_month_orders()}) GROUP BY order_month)))", ["orders_plain"]),
    "fmt_thousands": (
        f"SELECT order_month, key_sum, {thousands('key_sum')} AS key_sum_text FROM ("
        f"SELECT {month_of('o_orderdate')} AS order_month, CAST(sum(o_orderkey) AS BIGINT) AS key_sum "
        f"FROM orders GROUP BY 1)"),
    "fmt_fixed2": compose(
        f"SELECT order_month, {fixed2('CAST(n_closed AS DOUBLE) / nullif(n_rows, 0)')} AS completed_fraction_text "
        f"FROM ({_closed_share()})", ["orders_plain"]),
    "fmt_percent2": compose(
        f"SELECT order_month, {percent2('CAST(n_closed AS DOUBLE) / nullif(n_rows, 0) * 100')} AS completed_pct_text "
        f"FROM ({_closed_share()})", ["orders_plain"]),
    "phrase_cast": compose(
        f"SELECT product, month, {phrase('g', 'cast')} AS growth_phrase FROM ("
        f"SELECT *, round({growth('total_customer', 'prev_total_customer')}, 2) AS g FROM ({_product_months()}))",
        ["monthly_usage"]),
    "phrase_fixed2": compose(
        f"SELECT order_month, {phrase('g', 'fixed2')} AS growth_phrase FROM ("
        f"SELECT *, round({growth('total_orders', 'prev_total_orders')}, 2) AS g FROM ({_order_months()}))",
        ["orders_plain"]),
    "phrase_float": compose(
        f"SELECT customer_type, month, {phrase('g', 'float')} AS growth_phrase FROM ("
        f"SELECT *, round({growth('total_devices', 'prev_total_devices')}, 2) AS g FROM ("
        f"SELECT customer_type, {month_of('date')} AS month, "
        f"max(cumulative_a) + max(cumulative_b) + max(cumulative_c) AS total_devices, "
        f"lag(max(cumulative_a) + max(cumulative_b) + max(cumulative_c)) OVER "
        f"(PARTITION BY customer_type ORDER BY {month_of('date')}) AS prev_total_devices "
        f"FROM daily_metrics GROUP BY 1, 2))", ["daily_metrics"]),
    "phrase_traffic": compose(
        f"SELECT property, day, {phrase_traffic('views', 'prev_views')} AS growth_phrase FROM ("
        f"SELECT property, CAST(ts AS DATE) AS day, "
        f"count(*) FILTER (WHERE event_type = {q(LABELS.page_view_event)}) AS views, "
        f"lag(count(*) FILTER (WHERE event_type = {q(LABELS.page_view_event)})) OVER "
        f"(PARTITION BY property ORDER BY CAST(ts AS DATE)) AS prev_views "
        f"FROM traffic_events GROUP BY 1, 2)", ["traffic_events"]),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
