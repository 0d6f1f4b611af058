"""The README's own-tables example, run on sources written with the declared schemas."""

import os
import tempfile

from kpiframe import Period
from kpiframe.labels import DEFAULT_LABELS as labels
from kpiframe.operators import devices, orders, report, traffic, usage
from kpiframe.sources import mapped, schemas, sinks, tables
from kpiframe.sources.tables import DriverTables

from conftest import SF_SMALL


def test_readme_flow_on_written_sources(spark):
    base = tempfile.mkdtemp(prefix="kpiframe-src-")
    t = DriverTables(spark, SF_SMALL)
    sources = {
        "usage": mapped.monthly_usage(t.orders, t.customer),
        "orders": mapped.orders_flat(t.orders, t.customer, t.nation, t.region),
        "daily": mapped.daily_metrics(t.lineitem),
        "events": mapped.traffic_events(t.events),
    }
    for name, df in sources.items():
        df.write.parquet(os.path.join(base, name))

    p = Period("2001-08-15")
    tp = Period("2024-01-24", "week")
    use = tables.read_source(spark, os.path.join(base, "usage"), schemas.USAGE)
    ords = tables.read_source(spark, os.path.join(base, "orders"), schemas.ORDERS)
    daily = tables.read_source(spark, os.path.join(base, "daily"), schemas.DAILY_METRICS)
    events = tables.read_source(spark, os.path.join(base, "events"), schemas.TRAFFIC_EVENTS)

    k8 = traffic.traffic_summary(traffic.traffic_growth(traffic.traffic_metrics(events, tp, labels), tp))
    slots = report.report_slots([
        report.usage_slots(usage.usage_growth(use, p, labels), labels),
        report.progress_slots(orders.order_progress(ords, p, labels)),
        report.category_slots(orders.order_category(ords, p, labels), labels),
        report.device_slots(devices.device_growth(daily, p, labels), labels),
        traffic.traffic_all(k8, labels),
    ], p)
    phs = report.placeholder_table(spark, report.default_placeholders())
    report.assert_complete(slots, phs)
    out = os.path.join(base, "reports")
    sinks.write_reports(report.render_reports(report.slot_binding(slots, phs),
                                              report.template_table(spark, report.default_templates())), out)
    rendered = sinks.read_reports(spark, out).collect()
    assert len(rendered) == 6 and all("{" not in r.text for r in rendered)
    assert slots.count() == 67
