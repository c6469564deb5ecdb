"""Sinks. Text and tables are written by Spark in parallel; matrix trios and reports, which are single files by format, stream from the driver in order."""
