"""The 36 dashboard questions, in five sections.

A report is a function of the published tables that returns a frame; ``REPORTS`` holds
them by id (``q3_5``) and ``SECTIONS`` lists the ids of each dashboard section.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from paylens.plans.reports import (
    behaviour,
    geography,
    leakage,
    payment,
    summary,
)
from paylens.plans.tables import ReportTables

Report = Callable[[ReportTables], DataFrame]

_MODULES = {
    "Executive Summary": summary,
    "HV Customer Behaviour": behaviour,
    "Payment Behaviour & Preferences": payment,
    "Geographic Distribution": geography,
    "Revenue Leakage & Recommendations": leakage,
}

SECTIONS: dict[str, list[str]] = {title: list(m.REPORTS) for title, m in _MODULES.items()}
REPORTS: dict[str, Report] = {k: f for m in _MODULES.values() for k, f in m.REPORTS.items()}


def run_section(title: str, tables: ReportTables) -> dict[str, DataFrame]:
    return {key: REPORTS[key](tables) for key in SECTIONS[title]}
