"""Water-chemistry harmonisation on Spark.

Stations and lab results from five source programs are brought to one declared
schema, cleaned, de-duplicated, extended by ion charge balances and appended to
three tables.
"""

from .operators.balance import charge_balance
from .plans.jobs import parse_sources, post_process, seed, update
from .plans.tails import Tables, transform_results, transform_stations
from .sinks import create_tables, refresh_params
from .sqlcsv import query_csv, query_tables

__all__ = [
    "Tables",
    "charge_balance",
    "create_tables",
    "parse_sources",
    "post_process",
    "query_csv",
    "query_tables",
    "refresh_params",
    "seed",
    "transform_results",
    "transform_stations",
    "update",
]
