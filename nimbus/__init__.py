"""nimbus: a Spark-native library for periodic station observations.

Every operator takes DataFrames and column names and returns a DataFrame
built from built-in Spark expressions, so Catalyst sees one plan from the
scan to the sink.
"""

from nimbus.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
