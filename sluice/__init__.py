"""Spec-driven table pipelines on Spark: raw tables, row checks, typed clean tables, daily marts."""

from sluice.plans.pipeline import load_checked, load_raw, run, run_each
from sluice.plans.spec import TableSpec

__all__ = ["TableSpec", "load_checked", "load_raw", "run", "run_each"]
