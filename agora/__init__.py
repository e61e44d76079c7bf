"""agora: community-activity analytics on Spark.

Daily ingest of community posts and comments from landed snapshots, a
re-loadable user-by-day staging table, weekly activity masks and the KPIs read
from them, and an adult-content flag computed both as a batch query and as a
Structured Streaming job.  Everything is DataFrame / Spark SQL; no Python UDF
runs in a hot path.
"""

from agora.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
