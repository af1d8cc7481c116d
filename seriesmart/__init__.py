"""seriesmart: PySpark-native reporting marts over time-series feeds.

Layout:

* ``functions`` - column expressions: keys, guarded arithmetic, calendar.
* ``operators`` - DataFrame -> DataFrame operators: dedup, series windows,
  as-of join, pivot, quality checks, SCD2, merge/publish, measures.
* ``sources``   - control table, landed files, bronze readers, ledgers.
* ``streaming`` - Structured Streaming CDC into a versioned table.
* ``plans``     - the marts and the registered queries over the driver tables.

Every operator is built from Spark built-ins; there are no Python UDFs.
"""

__version__ = "0.1.0"

from .functions.calendar import bounded_spine, date_spine, dim_date  # noqa: E402
from .functions.keys import date_key, pipe_key, surrogate_key  # noqa: E402
from .functions.scalar import degree_days, safe_div  # noqa: E402
from .operators.asof import asof_join, multi_asof  # noqa: E402
from .operators.bucketed import read_bucketed, write_bucketed  # noqa: E402
from .operators.conform import conform_tall  # noqa: E402
from .operators.dedupe import latest_wins  # noqa: E402
from .operators.measures import share_levels  # noqa: E402
from .operators.merge import merge_upsert, publish, read_table  # noqa: E402
from .operators.nested import decode_jsonstat, flatten, parse_documents, path, zip_arrays  # noqa: E402
from .operators.pivot import cross_rates, pivot_series  # noqa: E402
from .operators.quality import freshness, gate, reconcile, run_checks  # noqa: E402
from .operators.scd2 import publish_history, scd2_apply, scd2_replay  # noqa: E402
from .operators.series import returns_and_rolling, rolling, with_change  # noqa: E402
from .sources.bronze import load_feeds  # noqa: E402
from .sources.control import landing_plan, read_control  # noqa: E402
from .sources.landing import load_pending, read_bronze, read_documents, read_positional_csv  # noqa: E402
from .streaming.bronze_feed import start_bronze_feed  # noqa: E402
from .streaming.cdc import start_cdc  # noqa: E402

__all__ = [
    "asof_join", "bounded_spine", "conform_tall", "cross_rates", "date_key", "date_spine",
    "decode_jsonstat", "degree_days", "dim_date", "flatten", "freshness", "gate", "landing_plan",
    "latest_wins", "load_feeds", "load_pending", "merge_upsert", "multi_asof", "parse_documents", "pipe_key",
    "path", "pivot_series", "publish", "publish_history", "read_bronze", "read_bucketed", "read_control", "read_documents", "read_positional_csv",
    "read_table", "reconcile", "returns_and_rolling", "rolling", "run_checks", "safe_div",
    "scd2_apply", "scd2_replay", "share_levels", "start_bronze_feed", "start_cdc",
    "surrogate_key", "with_change", "write_bucketed", "zip_arrays",
]
