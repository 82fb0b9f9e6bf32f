"""tradelake: a Spark-native trade ingest pipeline.

Decode JSON trade messages, validate and clean them with Catalyst expressions,
bucket them by minute, write partitioned Parquet, and load new files exactly once
into a day-partitioned table through a file ledger.
"""

from .session import ensure_utc, get_session, scratch_dir, shared_root

__all__ = ["ensure_utc", "get_session", "scratch_dir", "shared_root"]
