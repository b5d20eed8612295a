"""stratus: a Spark-native climate warehouse.

Every public operator is a function from DataFrame(s) to a DataFrame. Layout:

- ``functions``  column expressions (dates, rounding, text, JSON)
- ``sources``    scans, literal relations, generators, landed payloads
- ``operators``  dimensions, facts, mart, control plane, forecast, measures, writes
- ``streaming``  file-stream ingest with idempotent slice replacement
- ``plans``      bindings of the operators to the driver's tables and the end-to-end refresh
"""

from stratus.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
