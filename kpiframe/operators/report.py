"""K10-K12: slot table, placeholder binding and template rendering.

* K10 turns each KPI result into long ``(report_id, report_month, slot, value)``
  rows, ``report_month`` being the start of the report's period, which all
  later tables and the sink carry along, whatever the ids look like; the
  product/property label picks the slot suffix through a literal-map lookup
  inside the projection (no join), and unknown labels are dropped.
* K11 binds placeholders to slots: one aggregate gathers each report's values
  of the expected slots, one ``inline`` over the expected list gives every
  placeholder its value or NULL. A slot whose value is NULL is missing.
* K12 renders templates: per report, the bound ``(ord, placeholder, value)``
  triples (bounded by the placeholder count) are sorted by ``ord`` and folded
  over each template text of the report's deck with ``aggregate`` +
  ``replace``: every occurrence, case-sensitive, in order, so a value that
  itself contains a later placeholder is replaced again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiframe.functions.period import Period
from kpiframe.functions.text import label_lookup, slot_name
from kpiframe.labels import DEFAULT_LABELS, Labels
from kpiframe.plans.broadcast import small_table
from kpiframe.sources import schemas

REPORT_MONTH_SLOT = "report_month"
DEFAULT_DECK = "monthly"

# ---------------------------------------------------------------------------
# The monthly deck's slots in its order, with the suffixes of the
# default labels. They must equal what the deck's templates name.
# ---------------------------------------------------------------------------
DECK_SLOTS = (
    "report_month",
    "total_customer_building",
    "growth_customer_building",
    "total_customer_machinery",
    "growth_customer_machinery",
    "total_customer_household",
    "growth_customer_household",
    "total_mau_building",
    "mau_percentage_building",
    "growth_mau_building",
    "total_mau_machinery",
    "mau_percentage_machinery",
    "growth_mau_machinery",
    "total_mau_household",
    "mau_percentage_household",
    "growth_mau_household",
    "total_orders",
    "growth_orders",
    "total_completed_orders",
    "completed_orders_percentage",
    "total_on_progress_orders",
    "on_progress_orders_percentage",
    "remaining_order_building",
    "remaining_order_machinery",
    "remaining_order_regional",
    "total_remaining_order_regional",
    "contract_document",
    "total_visitors_website",
    "growth_total_visitors_website",
    "summary_website",
    "total_visitors_mobile",
    "growth_total_visitors_mobile",
    "page_views_mobile",
    "growth_page_views_mobile",
    "growth_engagement_rate_mobile",
    "total_devices_bundle",
    "growth_devices_bundle",
    "summary_partner",
    "total_visitors_partner",
    "growth_total_visitors_partner",
    "page_views_partner",
    "growth_page_views_partner",
    "growth_engagement_rate_partner",
    "growth_avg_engagement_time_partner",
    "total_devices_single",
    "growth_devices_single",
)
# ---------------------------------------------------------------------------


def _suffixed(df: DataFrame, label_col: str, mapping: dict[str, str], names: Sequence[tuple[str, str]],
              by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, slot, value)``: ``name_suffix`` per (name, value column).

    The suffix is a literal-map lookup of the label; unknown labels (NULL
    suffix) are dropped, as an inner join with the label table would.
    """
    suffix = label_lookup(F.col(label_col), mapping)
    pairs = F.inline(F.array(*[
        F.struct(slot_name(F.lit(n), F.col("_suffix")).alias("slot"), F.col(c).alias("value")) for n, c in names
    ]))
    return df.select("*", suffix.alias("_suffix")).filter(F.col("_suffix").isNotNull()).select(*by, pairs)


def _plain(df: DataFrame, names: Sequence[tuple[str, Column]], by: Sequence[str] = ()) -> DataFrame:
    pairs = F.inline(F.array(*[F.struct(F.lit(n).alias("slot"), c.alias("value")) for n, c in names]))
    return df.select(*by, pairs)


def usage_slots(fused: DataFrame, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = ()) -> DataFrame:
    """K1 + K2 slots from the fused usage rows, in one projection."""
    return _suffixed(fused, "product", labels.product_suffix, [
        ("total_customer", "total_customer_text"), ("growth_customer", "growth_phrase"),
        ("total_mau", "total_mau_text"), ("mau_percentage", "mau_percentage_text"),
        ("growth_mau", "mau_growth_phrase"),
    ], by)


def progress_slots(k3: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _plain(k3, [
        ("total_orders", F.col("total_orders_text")),
        ("growth_orders", F.col("growth_phrase")),
        ("total_completed_orders", F.col("total_completed_text")),
        ("completed_orders_percentage", F.col("completed_pct_text")),
        ("total_on_progress_orders", F.col("total_on_progress_text")),
        ("on_progress_orders_percentage", F.col("on_progress_pct_text")),
    ], by)


def category_slots(k4: DataFrame, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = ()) -> DataFrame:
    """K4 slots in one projection (no per-category branches, so K4 runs once).

    ``status`` -> ``contract_document``; ``product`` -> ``remaining_order_<suffix>``
    (unknown products dropped); ``regional`` -> ``remaining_order_regional``
    (the label) and ``total_remaining_order_regional`` (the count).
    """
    cat = F.col("category")
    share = {p: labels.product_suffix[p] for p in labels.share_products if p in labels.product_suffix}
    first_slot = (
        F.when(cat == "status", F.lit("contract_document"))
        .when(cat == "product", slot_name(F.lit("remaining_order"), label_lookup(F.col("label"), share)))
        .when(cat == "regional", F.lit("remaining_order_regional"))
    )
    first_value = F.when(cat == "regional", F.col("label")).otherwise(F.col("total_orders"))
    second_slot = F.when(cat == "regional", F.lit("total_remaining_order_regional"))
    pairs = F.inline(F.array(
        F.struct(first_slot.alias("slot"), first_value.alias("value")),
        F.struct(second_slot.alias("slot"), F.col("total_orders").alias("value")),
    ))
    return k4.select(*by, pairs).filter(F.col("slot").isNotNull())


def device_slots(k5: DataFrame, labels: Labels = DEFAULT_LABELS, by: Sequence[str] = ()) -> DataFrame:
    arms = {name: name for name, _ in labels.device_arms}
    return _suffixed(k5, "product_type", arms,
                     [("total_devices", "total_devices_text"), ("growth_devices", "growth_phrase")], by)


def report_key(period: Period, by: Sequence[str]) -> Column:
    """A report's id: the period's ISO start and the ``by`` values, each after a
    ``/``. Values have ``\\`` and ``/`` escaped and NULL is ``\\N``, so no two
    reports share an id."""
    def encoded(c: str) -> Column:
        text = F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(text, F.lit("/"), F.lit("\\/")), F.lit("\\N"))

    return F.concat_ws("/", F.lit(period.current_start.isoformat()), *[encoded(c) for c in by])


#: A slot row while parts are merged: the part's and its own place decide.
_ROW = "struct<slot:string,value:string,_part:int,_ord:bigint>"


def _rows(part: DataFrame, place: int, by: Sequence[str] = ()) -> DataFrame:
    ord_ = F.col("ord") if "ord" in part.columns else F.lit(None)
    return part.select(*by, F.struct("slot", "value", F.lit(place).alias("_part"), ord_.alias("_ord")).cast(_ROW).alias("_row"))


def report_slots(parts: Sequence[DataFrame], period: Period, report_id: str | Column | None = None,
                 by: Sequence[str] = (), shared: Sequence[DataFrame] = (),
                 reports: DataFrame | None = None) -> DataFrame:
    """K10: union of slot parts as ``(report_id, report_month, slot, value)``.

    Parts are merged like dicts (U3): if two parts produce the same slot of a
    report, the later part wins; inside one part the row with the largest
    ``ord`` does, where the part has that column, and of equals the largest
    value, so reruns agree. That is one small ``groupBy(report_id, slot)`` over
    slot rows, which are bounded per report by the report's size. The report
    month label (from ``period``) is added as slot ``report_month``, before
    all parts.

    With ``by`` keys there is one report per group, and the id is
    :func:`report_key`; otherwise it is ``report_id`` (default: the ISO start
    of the period). ``shared`` parts (slots without ``by`` keys, before the
    others in the merge) go to every report: they are gathered once into an
    array, bounded by the slots of a report, and unpacked beside each report's
    own rows, so nothing is joined and no part is computed per report.
    ``reports`` (the ``by`` keys) names reports to make even if no part has a
    row for them.
    """
    if by:
        rid = report_key(period, by)
    elif report_id is None:
        rid = F.lit(period.current_start.isoformat())
    else:
        rid = report_id if isinstance(report_id, Column) else F.lit(report_id)
    month = F.struct(F.lit(REPORT_MONTH_SLOT).alias("slot"), period.label().alias("value"), F.lit(0).alias("_part"),
                     F.lit(None).alias("_ord")).cast(_ROW)
    common = [_rows(p, i + 1) for i, p in enumerate(shared)]
    own = [_rows(p, len(shared) + i + 1, by) for i, p in enumerate(parts)]
    if not by:
        first = parts[0].sparkSession.range(0, 1, 1, 1).select(month.alias("_row"))
        rows = reduce(DataFrame.unionByName, [first, *common, *own]).select(rid.alias("report_id"), "_row.*")
    else:
        if reports is not None:
            own.append(reports.select(*by, F.lit(None).cast(_ROW).alias("_row")))
        every = F.array(month)
        if common:
            gathered = reduce(DataFrame.unionByName, common).select(F.sort_array(F.collect_list("_row")))
            every = F.concat(every, gathered.scalar())
        # collect_list leaves the NULL rows of bare reports out
        rows = (reduce(DataFrame.unionByName, own).groupBy(rid.alias("report_id")).agg(F.collect_list("_row").alias("_own"))
                .select("report_id", F.inline(F.concat("_own", every))))
    winner = F.max_by(F.struct("value"), F.struct("_part", "_ord", "value"))["value"]
    return rows.groupBy("report_id", F.lit(period.current_start).alias("report_month"), "slot").agg(winner.alias("value"))


def _report(df: DataFrame) -> list[str]:
    """The columns that name a report: ``report_id`` and, if there, ``report_month``."""
    return [c for c in ("report_id", "report_month") if c in df.columns]


def default_placeholders() -> list[tuple[int, str, str]]:
    """The monthly deck's placeholder list ``(ord, placeholder, slot)``; the
    text of a placeholder is ``{slot}``."""
    return [(i + 1, "{" + s + "}", s) for i, s in enumerate(DECK_SLOTS)]


def placeholder_table(spark: SparkSession, rows: Sequence[tuple[int, str, str]] | None = None) -> DataFrame:
    return small_table(spark, rows if rows is not None else default_placeholders(), schemas.PLACEHOLDERS)


def slot_binding(slots: DataFrame, placeholders: DataFrame) -> DataFrame:
    """K11: ``(report_id, report_month, ord, placeholder, slot, value)`` for every
    placeholder of every report; ``value`` is NULL where the report has no value
    for it. The month is there if ``slots`` has it."""
    expected = placeholders.select(F.array_sort(F.collect_list(F.struct("ord", "placeholder", "slot")))).scalar()
    wanted = F.array_contains(expected.getField("slot"), F.col("slot")) & F.col("value").isNotNull()
    keys = _report(slots)
    per_report = slots.groupBy(*keys).agg(F.map_from_entries(
        F.collect_list(F.when(wanted, F.struct("slot", "value")))).alias("values"))
    return (per_report.select(*keys, "values", F.inline(expected))
            .select(*keys, "ord", "placeholder", "slot", F.try_element_at("values", "slot").alias("value")))


def slot_missing(slots: DataFrame, placeholders: DataFrame) -> DataFrame:
    """K11 strict check: ``(report_id, report_month, ord, placeholder, slot)``
    without a value."""
    return slot_binding(slots, placeholders).filter(F.col("value").isNull()).drop("value")


class MissingSlotsError(KeyError):
    """Raised by :func:`assert_complete` when a placeholder has no value."""


def assert_complete(slots: DataFrame, placeholders: DataFrame, show: int = 20) -> None:
    """Fail like the original report does when a placeholder has no value. The
    error has the full count and the first ``show``; :func:`slot_missing` has all."""
    missing = slot_missing(slots, placeholders)
    n = missing.count()
    if n:
        rows = missing.orderBy("report_id", "ord").limit(show).collect()
        listed = ", ".join(f"{r.report_id}:{r.placeholder}" for r in rows)
        raise MissingSlotsError(f"{n} placeholders without a value, the first {len(rows)}: {listed}")


def assert_decks(rendered: DataFrame) -> None:
    """Fail when a report names a deck that has no templates."""
    lost = rendered.filter(F.col("template_id").isNull())
    n = lost.count()
    if n:
        row = lost.first()
        raise KeyError(f"{n} reports name a deck without templates, such as {row.report_id}: {row.deck_id}")


def default_templates() -> list[tuple[str, str, str]]:
    """A small text deck using every default placeholder once or more."""
    rows = default_placeholders()
    by_slot = {slot: ph for _, ph, slot in rows}
    lines_usage = [f"{ph}" for _, ph, s in rows if s.startswith(("total_customer_", "growth_customer_"))]
    lines_mau = [f"{ph}" for _, ph, s in rows if "mau" in s]
    lines_orders = [ph for _, ph, s in rows if "order" in s or s == "contract_document"]
    lines_traffic = [ph for _, ph, s in rows if any(k in s for k in ("visitors", "page_views", "engagement",
                                                                     "summary"))]
    lines_devices = [ph for _, ph, s in rows if "devices" in s]
    month = by_slot[REPORT_MONTH_SLOT]
    return [
        (DEFAULT_DECK, "01_title", f"Monthly report - {month}"),
        (DEFAULT_DECK, "02_customers", f"Customers ({month}): " + " | ".join(lines_usage)),
        (DEFAULT_DECK, "03_active_users", "Active users: " + " | ".join(lines_mau)),
        (DEFAULT_DECK, "04_orders", "Orders: " + " | ".join(lines_orders)),
        (DEFAULT_DECK, "05_traffic", "Traffic: " + " | ".join(lines_traffic)),
        (DEFAULT_DECK, "06_devices", "Devices: " + " | ".join(lines_devices)),
    ]


def template_table(spark: SparkSession, rows: Sequence[tuple[str, str, str]] | None = None) -> DataFrame:
    return small_table(spark, rows if rows is not None else default_templates(), schemas.TEMPLATES)


def render_reports(bindings: DataFrame, templates: DataFrame, deck_id: str | Column = DEFAULT_DECK,
                   reports: DataFrame | None = None) -> DataFrame:
    """K12: ``(report_id, report_month, deck_id, template_id, text)`` with
    placeholders filled.

    ``bindings`` is K11's output (or any ``report_id, ord, placeholder,
    value``); the month is there if ``reports``, or else ``bindings``, has it.
    A NULL value leaves its placeholder in place. ``deck_id`` (a
    literal, or a column of ``reports`` or else of ``bindings``) names the
    template deck a report uses. ``reports`` (``report_id`` and the deck's
    column) lists the reports to render, among them those with nothing to
    replace, whose templates stay as they are. A report whose deck has no
    templates keeps one row with NULL template and text (:func:`assert_decks`).
    """
    deck = F.lit(deck_id) if isinstance(deck_id, str) else deck_id
    pairs = F.array_sort(F.collect_list(F.struct("ord", "placeholder", "value"))).alias("pairs")
    if reports is None:
        keys = _report(bindings)
        per_report = bindings.groupBy(*keys).agg(F.min(deck).alias("deck_id"), pairs)
    else:
        keys = _report(reports)
        both = [k for k in keys if k in bindings.columns]
        named = reports.groupBy(*keys).agg(F.min(deck).alias("deck_id"))
        per_report = named.join(bindings.groupBy(*both).agg(pairs), both, "left")
    fold = F.aggregate(
        "pairs", F.col("text"),
        lambda acc, p: F.when(p["value"].isNull(), acc).otherwise(F.replace(acc, p["placeholder"], p["value"])),
    )
    return per_report.join(templates, "deck_id", "left").select(
        *keys, "deck_id", "template_id", F.when(F.col("pairs").isNull(), F.col("text")).otherwise(fold).alias("text"))
