"""The end-to-end monthly job (the original entry point, re-aimed)."""

import os
import tempfile

import pytest

from kpiframe.__main__ import main
from kpiframe.functions.period import Period
from kpiframe.monthly import MonthlyReport
from kpiframe.operators.report import MissingSlotsError
from kpiframe.sources.sinks import read_reports

from conftest import SF_SMALL


def test_cli_writes_rendered_report(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="kpiframe-out-"), "reports")
    main(["--tables", SF_SMALL, "--as-of", "2001-08-15", "--traffic-as-of", "2024-01-24",
          "--traffic-unit", "week", "--out", out, "--master", "local[*]"])
    rows = read_reports(spark, out).collect()
    assert len(rows) == 6 and {r.report_id for r in rows} == {"2001-07-01"}
    assert all("{" not in r.text for r in rows)
    title = [r.text for r in rows if r.template_id == "01_title"]
    assert title == ["Monthly report - July 2001"]


def test_strict_mode_fails_without_traffic_data(spark):
    # Traffic as of 2001: no events in those weeks -> traffic slots missing -> strict check fails.
    rep = MonthlyReport(spark, SF_SMALL, Period("2001-08-15"), Period("2001-08-15", "week"))
    with pytest.raises(MissingSlotsError):
        rep.run(os.path.join(tempfile.mkdtemp(prefix="kpiframe-out-"), "r"))
    assert rep.missing().count() == 15


def test_run_checkpoints_the_slot_table_once(spark):
    from kpiframe.session import checkpoint_dir
    assert checkpoint_dir(spark)  # set by conftest only because the test session had none
    rep = MonthlyReport(spark, SF_SMALL, Period("2001-08-15"), Period("2024-01-24", "week"))
    out = os.path.join(tempfile.mkdtemp(prefix="kpiframe-out-"), "r")
    rep.run(out)
    assert len(read_reports(spark, out).collect()) == 6
