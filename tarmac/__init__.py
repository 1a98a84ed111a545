"""Spark-native analytics for airline flight delays.

``sources``    typed readers and table sinks
``functions``  Column builders: KPI arithmetic, clock parsing, business rules
``operators``  profiling, dimension and fact builders, integrity checks, trailing history
``plans``      the KPI views, exploratory aggregates and delay models
``streaming``  resumable file ingestion
``oracle``     the same results written as SQL for an independent check
"""
