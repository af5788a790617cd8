"""packetloom: a PySpark-native engine for document-packet evidence.

Packets of scanned pages live in ordinary Spark tables (tokens, lines,
candidate evidence, predictions, labels).  Every operator takes and returns
DataFrames, so Catalyst plans whole pipelines at once.
"""

__version__ = "0.1.0"
