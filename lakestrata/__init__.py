"""lakestrata: layered (landing → bronze → silver → gold) lakehouse analytics on stock Spark SQL.

Every operator is a pure ``DataFrame -> DataFrame`` function built from ``pyspark.sql.functions``;
only :mod:`lakestrata.sources` and :mod:`lakestrata.plans.jobs` touch paths.
"""

__version__ = "0.1.0"
