"""riskspark — loan-default analytics as Spark DataFrame functions.

Every public operator is a plain ``DataFrame -> DataFrame`` (or
``DataFrame -> small DataFrame``) function built on Spark SQL, Spark ML and
Structured Streaming, so the same code runs on ``local[*]`` and on a cluster.

Sub-packages:

* ``sources``   – readers / writers (CSV, Parquet, JSON prediction log, outcomes,
                  the test-table loan view).
* ``functions`` – column expressions (parsing, interactions, bands, decisions).
* ``operators`` – contracts, cleaning, profiling, rank metrics, scoring,
                  monitoring, models, explanations.
* ``plans``     – the registered named queries and their SQL oracles.
* ``streaming`` – Structured Streaming versions of scoring and monitoring.
"""

__version__ = "0.1.0"
