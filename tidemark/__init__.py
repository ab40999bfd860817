"""Change-data lakehouse operators for PySpark.

Every operator takes and returns DataFrames, so the same function runs in a
batch job, in ``foreachBatch`` and in a test.  Clocks and user names are
arguments; nothing keeps module state.
"""

__version__ = "0.1.0"
