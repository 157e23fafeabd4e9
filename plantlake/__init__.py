"""Spark-native analytics for process-industry data.

``functions``  column rules (status bands, ratios, scores)
``operators``  DataFrame -> DataFrame steps (enrichment, metrics, latest row, ordering)
``sources``    batch and streaming readers, writers, record encoding
``streaming``  incremental ingest and the streaming form of the operators
``plans``      silver, gold and dashboard datasets, synthetic plant tables
``queries``    every operator bound to the test tables, with its oracle SQL
"""

__version__ = "0.1.0"
