"""Tidelog: table-change capture, transport and application on Spark.

Decode change envelopes, convert between change representations, apply changes
to keyed tables as set-based jobs, and land feeds as files or partitioned tables.
"""

__version__ = "0.1.0"
