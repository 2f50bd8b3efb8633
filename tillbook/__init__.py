"""Payments-reporting operators for Spark.

``sources``    scans, header and column rules, sinks
``functions``  column expressions: identifiers, money, text, periods
``operators``  lookups, rollups, deduplication, merge, incremental loads
``plans``      the reports, as compositions of the above
``streaming``  the incremental loads on Structured Streaming
"""
