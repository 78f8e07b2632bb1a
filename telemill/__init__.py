"""Ingestion of JSON device telemetry into time-series tables, on Spark."""

from telemill.operators.reads import latest, scan, time_range
from telemill.options import Options
from telemill.plans.load import LoadReport, load, unpark
from telemill.plans.parse import parse, register_parser
from telemill.session import configure
from telemill.streaming.ingest import start_ingest

__all__ = [
    "LoadReport",
    "Options",
    "configure",
    "latest",
    "load",
    "parse",
    "register_parser",
    "scan",
    "start_ingest",
    "time_range",
    "unpark",
]
