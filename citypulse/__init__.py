"""citypulse: spatio-temporal incident analytics as Spark DataFrame jobs.

Every public operator is a function ``DataFrame -> DataFrame`` (or a
small bundle of DataFrames) built from Spark SQL expressions, windows,
joins and Spark ML. Nothing is collected to the driver except scalar
metadata that Spark itself computes (e.g. a cut-off date is kept as a
one-row DataFrame and cross-joined, never pulled).
"""

__version__ = "0.1.0"
