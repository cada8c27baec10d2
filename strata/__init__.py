"""strata: parameter-driven bronze -> silver -> gold batch pipelines on Spark.

Layers, data quality and a run ledger, all as Spark DataFrame / SQL jobs.
See README.md for the map of modules.
"""

__version__ = "0.1.0"
