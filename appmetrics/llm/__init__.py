"""Operators for training-data pipelines: search, tokenising, mixing, deduplication, sharding, filtering.

Each module holds one operator with a general interface; ``queries`` applies them to the driver's tables.
Functions that run in Spark tasks are imported by name there, so the package must be on the executors'
Python path.
"""
