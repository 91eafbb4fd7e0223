"""tidewater — Spark-native batch BI and rule-based text enrichment.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions (no Python UDFs), so Catalyst can prune, push down and fuse it
into whole-stage code generation.
"""

from tidewater.session import build_session

__all__ = ["build_session"]
