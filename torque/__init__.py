"""torque: sales ETL/ELT jobs as Spark DataFrame plans.

The operators most users need, in one place::

    from torque import merge, sales_wide, fact_sales, normalize_currency, etl_rules, SnapshotTable
"""

from .functions.normalize import normalize_currency
from .functions.windows import Window, changed_in, event_window, year_window
from .operators.merge import (CONCAT, CUMULATIVE, PROGRESS, REPLACE, SKIP_IF_NULL, append_strict,
                              dedupe_last, delete_by_key, delete_cascade, merge, update_only)
from .operators.quality import apply_rules, etl_rules, rule_report, split_rules
from .operators.star import dim_car_detail, dim_car_detail_semi, fact_sales, sales_wide
from .plans.elt import run_elt
from .plans.etl import run_etl
from .sources.rates import RatesSnapshot, read_rates_document
from .sources.snapshots import SnapshotTable
from .sources.tables import read_source_tables

__version__ = "0.1.0"

__all__ = [
    "CONCAT", "CUMULATIVE", "PROGRESS", "REPLACE", "SKIP_IF_NULL", "RatesSnapshot", "SnapshotTable",
    "Window", "append_strict", "apply_rules", "changed_in", "dedupe_last", "delete_by_key",
    "delete_cascade", "dim_car_detail", "dim_car_detail_semi", "etl_rules", "event_window", "fact_sales",
    "merge", "normalize_currency", "read_rates_document", "read_source_tables", "rule_report", "run_elt",
    "run_etl", "sales_wide", "split_rules", "update_only", "year_window",
]
