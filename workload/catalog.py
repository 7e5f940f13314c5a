"""Imports every query module so that the registry is complete."""

import importlib

from workload.registry import QUERIES, run

MODULES = ("q_events", "q_assess", "q_calendar", "q_grades", "q_store", "q_quality", "q_sources")

for _name in MODULES:
    importlib.import_module(f"workload.{_name}")

__all__ = ["QUERIES", "run"]
