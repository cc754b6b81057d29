"""recordlog: record-log processing on Spark (batch and Structured Streaming).

Modules: ``sources`` (log readers, codecs), ``functions`` (column rules),
``operators`` (selection, offsets, results, replay, tables, produce),
``streaming`` (consume loop, replay stream, push queries, sinks) and
``plans`` (the registered queries and their fixtures).
"""
from .sources.log import LOG_SCHEMA, flat, log_from_events, read_log, stream_log, write_log

__version__ = "0.1.0"
__all__ = ["LOG_SCHEMA", "flat", "log_from_events", "read_log", "stream_log", "write_log"]
