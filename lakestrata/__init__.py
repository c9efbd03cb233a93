"""lakestrata: layered (bronze / silver / gold) table analytics on PySpark.

Every public function takes and returns DataFrames (or writes tables) and is
built from public Spark DataFrame, SQL and Structured Streaming functions.
"""

from lakestrata.session import AS_OF, RUNS_AS_OF, get_session, scratch_dir, scratch_scope

__all__ = ["AS_OF", "RUNS_AS_OF", "get_session", "scratch_dir", "scratch_scope"]
