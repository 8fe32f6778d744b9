"""Interval forecasting and live telemetry, written as Spark DataFrame work.

Readings are resampled to fixed intervals, joined with static and time-varying
dimensions, turned into features by one set of column expressions, and scored in
batch or on a stream by one saved pipeline.  Layers, lowest first:

``functions``  column expressions without any DataFrame
``operators``  DataFrame -> DataFrame, column names as arguments
``sources``    tables, message buses, sinks, artifacts, scratch space
``streaming``  event time, windows, stream scoring, query supervision
``plans``      complete jobs over the domain schema
"""
