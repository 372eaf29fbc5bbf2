"""labormart: job-vacancy analytics on Spark DataFrames, batch and streaming.

Sub-packages:

* ``functions``  column expressions (lenient casts, ASCII case folding, bands, ...)
* ``sources``    JSONL / Parquet / message / page readers and the sinks
* ``operators``  cleaning, validation, aggregates, distributions, skills, profiles, windows
* ``plans``      adapters from the driver tables and the registered query catalog
* ``streaming``  Structured Streaming forms of the window operators, sinks and fan-out
* ``jobs``       analyze / consume / collect / dashboard entry points (``python -m labormart.jobs``)
"""

from labormart.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
