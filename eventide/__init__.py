"""eventide: user-behaviour analytics on Spark DataFrames.

The same operator functions run on batch DataFrames and, where Spark allows it,
on Structured Streaming DataFrames.  Sub-packages:

* ``sources``   - text-line parsers, connector option builders, fixture views
* ``functions`` - column-expression helpers (predicates, bitmap hash, formatting)
* ``operators`` - DataFrame -> DataFrame operators (windows, top-N, distinct,
                  capping, sequences, matching, lateness)
* ``plans``     - one job per query name, plus the DuckDB oracle SQL
* ``streaming`` - event time / watermarks, sinks, stateful processors, twins
"""

from eventide.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
