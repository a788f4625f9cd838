"""Incremental month loads over a file stream.

The reference has no streaming operators; its incremental unit is the month
file (truncate the month, load it again).  :mod:`monthly_files` expresses
exactly that as a Structured Streaming file source run with an
``availableNow`` trigger: new monthly files are picked up once, cleaned, and
each micro-batch replaces the (year, month) partitions it touches.
"""
