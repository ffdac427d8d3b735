"""quarry: a Spark-native medallion toolkit for untrustworthy tabular feeds.

Layers
------
* ``sources``   readers for messy inputs (ragged CSV, paged JSON, HTML tables, wide sheets, seeds)
* ``operators`` landing by content hash, declarative checks, quarantine, dedup/conflicts,
                data tests, reconciliation, serving helpers
* ``functions`` Column-level helpers (labels, numbers, dates, hashes, JSON, quotes)
* ``plans``     silver/gold/serving builds wired from the operators
* ``streaming`` incremental landing with Structured Streaming
"""

__version__ = "0.1.0"

from quarry.operators.checks import Check, ColumnSpec, RowCheck, TableSpec, split, validate  # noqa: E402
from quarry.operators.data_tests import run_data_tests  # noqa: E402
from quarry.operators.dedup import resolve_duplicates  # noqa: E402
from quarry.operators.landing import compact_bronze, land, landing_counts, new_rows  # noqa: E402
from quarry.operators.reconcile import reconcile  # noqa: E402
from quarry.plans.gold import build_gold, gold_tests, publish_gold  # noqa: E402
from quarry.plans.silver import SourceDef, accounting, build_silver, classify, run_all  # noqa: E402
from quarry.session import get_spark  # noqa: E402
from quarry.sources import (extract_html_table, melt_wide, read_paged_json, read_ragged_csv,  # noqa: E402
                            read_seed)
from quarry.streaming import land_stream  # noqa: E402

__all__ = ["Check", "ColumnSpec", "RowCheck", "TableSpec", "split", "validate", "run_data_tests",
           "resolve_duplicates", "compact_bronze", "land", "landing_counts", "new_rows", "reconcile",
           "build_gold", "gold_tests", "publish_gold", "SourceDef", "accounting", "build_silver", "classify",
           "run_all", "get_spark", "extract_html_table", "melt_wide", "read_paged_json", "read_ragged_csv",
           "read_seed", "land_stream"]
