"""Spark-native URL-frontier analytics.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns); Spark SQL does all execution.  Sub-packages:

* ``functions``  - Column-level URL / hash / date / map functions
* ``sources``    - bucket folders, queue files, keyed tables, stats deltas
* ``operators``  - page extraction, routing, upserts, selection, scoring,
                   rolloff, re-keying, aggregations
* ``streaming``  - Structured Streaming jobs and log analytics
* ``plans``      - registered end-to-end queries over the driver tables
"""

__version__ = "0.1.0"
