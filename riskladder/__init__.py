"""riskladder: five-step (R1-R5) fund risk rating as PySpark DataFrame jobs.

Layout
------
sources/    schemas, CSV/parquet readers, result sinks, TESTDATA stand-in tables
functions/  calendar helpers, fixed lookup values, rating rules as Column expressions
operators/  reusable DataFrame operators (as-of top-1, tree flattening, volatility, ...)
plans/      the quarterly and daily rating jobs built from the operators, plus the
            query catalogue used by ``__spark_entry__``
streaming/  the daily new-fund rating driven by Structured Streaming ``foreachBatch``
"""

from riskladder.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
