"""tallyhouse: store-profit analytics as Spark DataFrame jobs.

Layers, from the outside in:

* ``sources``    land shop JSON and cost sheets, seeds, idempotent loads
* ``functions``  Column -> Column helpers (cleaning, keys, money)
* ``operators``  DataFrame -> DataFrame helpers (joins, windows, top-k, checks)
* ``plans``      the star: staging, dimensions, facts, marts, measures, periods
* ``streaming``  micro-batch ingest with the same row logic
"""
