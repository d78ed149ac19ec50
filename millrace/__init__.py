"""millrace: data preparation, profiling and model building on Spark DataFrames.

Every data-dependent operator is a fit / transform pair.  ``fit`` runs a small,
fixed number of aggregate jobs and returns a JSON-serialisable step;
``transform`` is a projection (or a left join against a fitted dictionary), so
it works unchanged on batch and streaming DataFrames.
"""

from millrace.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
