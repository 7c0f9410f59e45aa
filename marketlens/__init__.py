"""marketlens: end-of-day market analytics as plain PySpark DataFrame functions.

Every public function takes DataFrames (and keyword parameters) and returns a
DataFrame; nothing is collected to the driver.  Sub-packages:

* ``sources``   - readers, derived bar views over the driver tables, sinks
* ``functions`` - column expressions and window helpers shared by operators
* ``operators`` - cleaning, profiles, indicators, anomalies, signals,
                  rankings, lookups, collection reports, alerts, clusters
* ``plans``     - composite jobs and the query catalog used by the driver
* ``streaming`` - incremental snapshot ingest (Structured Streaming)
"""

__version__ = "0.1.0"
