"""The monthly report end to end: slots -> binding -> strict check -> render -> write.

This is the whole original job (queries, text values, placeholder map,
template fill) as one Spark application. Chart screenshots and slide
plumbing are not part of it (see README).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from kpiframe.functions.period import Period
from kpiframe.labels import DEFAULT_LABELS, Labels
from kpiframe.operators import report
from kpiframe.queries.registry import Ctx
from kpiframe.sources.counters import DailyCounters
from kpiframe.sources.layout import Bucketed
from kpiframe.sources.sinks import read_slots, write_reports, write_slots


@dataclass
class MonthlyReport:
    """The monthly report over the driver tables in ``tables_dir``, or one for
    every group of ``by``."""

    spark: SparkSession
    tables_dir: str
    kpi_period: Period
    traffic_period: Period
    labels: Labels = field(default_factory=lambda: DEFAULT_LABELS)
    placeholders: Sequence[tuple[int, str, str]] | None = None
    templates: Sequence[tuple[str, str, str]] | None = None
    #: ``("nation",)`` or ``("regional",)``: a whole deck for each, in one job.
    by: Sequence[str] = ()
    #: Where K5's running counters are kept between reports; unset, they are
    #: summed from all of lineitem each time.
    counters: str | None = None
    #: Prefix of tables that ``sources.layout.Bucketed`` stored; unset, K1-K4
    #: read the plain files.
    bucketed: str | None = None

    @cached_property
    def _ctx(self) -> Ctx:
        return Ctx(self.spark, self.tables_dir, self.kpi_period, self.traffic_period, self.labels,
                   counters=DailyCounters(self.spark, self.counters) if self.counters else None,
                   stored=Bucketed(self.spark, self.bucketed) if self.bucketed else None)

    def slots(self) -> DataFrame:
        return self._ctx.slots(self.by)

    def _placeholders(self) -> DataFrame:
        return report.placeholder_table(self.spark, report.default_placeholders() if self.placeholders is None else self.placeholders)

    def bindings(self) -> DataFrame:
        return report.slot_binding(self.slots(), self._placeholders())

    def missing(self) -> DataFrame:
        return report.slot_missing(self.slots(), self._placeholders())

    def rendered(self) -> DataFrame:
        return self._render(self.slots())

    def _render(self, slots: DataFrame) -> DataFrame:
        templates = report.template_table(
            self.spark, report.default_templates() if self.templates is None else self.templates)
        return report.render_reports(report.slot_binding(slots, self._placeholders()), templates,
                                     reports=slots.select("report_id", "report_month"))

    def run(self, out: str, strict: bool = True) -> None:
        """Fail if a placeholder has no value (``strict``), then write the text.

        The check and the rendering both need the slot table, so it is
        computed once: written next to the output (``<out>_slots``, a small
        table with one row per slot per report) and read back by both.
        """
        path = out.rstrip("/") + "_slots"
        write_slots(self.slots(), path)
        slots = read_slots(self.spark, path, self.kpi_period.current_start)
        rendered = self._render(slots)
        if strict:
            report.assert_complete(slots, self._placeholders())
            report.assert_decks(rendered)
        write_reports(rendered, out)
