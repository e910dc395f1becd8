"""tidepool: Spark-native social, event-health and 2-D clustering analytics.

Every job is a plain function from DataFrames (plus named parameters) to a
DataFrame, expressed with Spark SQL's built-in joins, aggregates and
expressions so that Catalyst and AQE choose the physical plan.

Layout:
  sources/    schemas, delimited-text readers and writers, driver-table views
  functions/  column expressions (distance, nearest centre, text checks, time)
  operators/  reusable relational building blocks (top-k, anti/semi joins,
              zero-filled counts, bounded broadcast)
  plans/      the data jobs (social, health, kmeans, synth) and the registry
"""

from tidepool.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
