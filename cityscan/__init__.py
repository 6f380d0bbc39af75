"""cityscan: Spark-native analytics over point events, code lists, sites and zones.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built from
built-in Spark columns; nothing is collected to the driver except bounded
planning scalars (a site count, an extent), and those are always size-checked.
"""

from cityscan.session import build_session, checkpoint_dir, ensure_parallelism

__all__ = ["build_session", "checkpoint_dir", "ensure_parallelism"]
