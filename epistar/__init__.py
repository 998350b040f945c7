"""epistar: a Spark-native surveillance ETL and star-schema engine.

Every operator is a DataFrame / SQL expression: schema-adaptive cleaning,
long-to-wide projection, ISO-week arithmetic, first-non-null merging,
exact -> fuzzy -> fallback code resolution, running totals, week-interval
joins, surrogate keys with an unknown member, versioned upserts and
star-schema trend queries.
"""

from epistar.session import build_session, checkpoint_dir, cut_lineage

__all__ = ["build_session", "checkpoint_dir", "cut_lineage"]
