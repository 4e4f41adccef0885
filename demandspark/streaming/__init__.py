from .ingest import ingest_stats, ingest_stream, read_log, rollup_stream, run_available
from .views import merge_and_refresh, refresh_months

__all__ = ["ingest_stats", "ingest_stream", "merge_and_refresh", "read_log", "refresh_months", "rollup_stream", "run_available"]
