"""lectern: catalogue integration on Spark DataFrames.

Sub-packages
------------
functions   column expressions: text, codes, dates, nested cells, vocabularies, similarity
sources     readers and sinks
operators   DataFrame in, DataFrame out: conform, dedup, model, match, enrich, quality, reports
plans       whole flows, and the registered queries with their SQL counterparts
streaming   the incremental operators applied per micro-batch
"""
