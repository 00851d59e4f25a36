"""tallyworks: transaction and log analytics as Spark jobs.

Everything here takes and returns DataFrames built from Spark's own functions, so
that Catalyst sees the whole plan; there is no Python UDF in the package.
"""

__version__ = "0.1.0"
