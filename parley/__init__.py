"""parley — Spark-native conversation and CSAT analytics.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, joins, windows and aggregates.  Sub-packages:

* ``sources``   — table scans, fixture views, CSV/JSON/Parquet sources and sinks
* ``functions`` — column-expression helpers and fixed rule values
* ``operators`` — transcript parsing, sentiment, features, portfolio, metrics,
                  modelling, attribution, phrase evidence, coaching
* ``plans``     — end-to-end jobs (training, scoring, call report, portfolio)
                  and the registered queries with their SQL oracles
* ``streaming`` — Structured Streaming jobs (stream scoring, windowed stats)
"""

__version__ = "0.1.0"
