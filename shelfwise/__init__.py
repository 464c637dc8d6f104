"""shelfwise: inventory snapshot and risk analytics on Spark.

Layers (all DataFrame -> DataFrame, lazily planned by Catalyst):

* ``sources``   landing envelopes (VARIANT), CSV, path-based layer tables
* ``functions`` column expressions: risk signals, date keys, sanitizers
* ``operators`` top-1-per-key dedup, incremental merge, data-quality checks,
                size-checked broadcast
* ``plans``     the layer models (stg / int / fct / dims), dashboard insights,
                the per-batch pipeline
* ``streaming`` Structured Streaming micro-batch driver (foreachBatch)
"""

from shelfwise.session import build_session, scratch_dir  # noqa: F401

__all__ = ["build_session", "scratch_dir"]
