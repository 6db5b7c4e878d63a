"""Streaming: intentionally empty.

The reference has no stream source, watermark, windowed or stateful stream
operator; every load is a full replacement and the append mode it declares is
never used.  Its batch work lives in ``strata.plans`` (the pipeline) and
``strata.sources.io`` (``load_table(..., mode="append")``).
"""
