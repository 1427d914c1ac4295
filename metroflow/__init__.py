"""metroflow: transit-feed analytics as Spark DataFrame jobs.

Layout
------
``functions``  column expressions (route dimension, classification, time)
``operators``  DataFrame -> DataFrame steps (parse, filter, state, aggregate, order)
``sources``    table scans and feed sources
``plans``      composite dashboard/API queries and the query catalog
``streaming``  sinks and Structured Streaming jobs
"""

__version__ = "0.1.0"
