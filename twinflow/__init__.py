"""Observation requests and platform messages as Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame, so it works the same
in a batch job, in ``df.transform(...)`` and inside ``foreachBatch``.
"""

__version__ = "0.1.0"
