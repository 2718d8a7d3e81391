"""Training-data operators: deduplication, scans, joins, sharding, mixing, token files.

Every operator is a function over DataFrames with its own general interface;
``queries.py`` wraps each one over the driver tables.
"""
