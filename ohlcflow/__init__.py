"""Price-bar analytics on Spark.

Every public function takes and returns DataFrames or Columns, so the same
code composes with ``DataFrame.transform`` on batch tables and on streams.
"""

__version__ = "0.1.0"
