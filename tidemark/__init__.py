"""Tidemark: subscription-business analytics as Spark DataFrame jobs.

Every public function takes and returns DataFrames, takes its evaluation time
and thresholds as arguments, and leaves the choice of sink to the caller.
"""

__version__ = "0.1.0"
