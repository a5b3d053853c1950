"""salesmart: retail-sales analytics as plain Spark DataFrame operators.

Every public operator is a function ``f(df, ...) -> DataFrame`` that stays
lazy, so it composes with ``DataFrame.transform`` and Catalyst sees the whole
plan from scan to sink.
"""

from salesmart.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
