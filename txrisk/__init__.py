"""txrisk — transaction-risk analytics as Spark DataFrame / ML / Structured Streaming jobs.

Modules:
  sources/    typed scans, driver-table views, prepared-table and feature-table storage
  functions/  column-level helpers (time, hashing draws, literal tables)
  operators/  DataFrame -> DataFrame operators (rolling windows, prep, profiling,
              metrics, sampling, kNN, models, drift)
  streaming/  prequential replay as a Structured Streaming job
  plans/      composed experiment runs and the query catalogue
"""

__version__ = "0.1.0"
