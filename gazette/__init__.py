"""gazette: article processing as composable DataFrame -> DataFrame operators.

Every public operator takes and returns Spark DataFrames, runs unchanged on
batch and (where its semantics allow) streaming input, and never reads the
clock: anything relative to "now" takes an explicit ``as_of``.
"""

from gazette.session import get_session, tune

__all__ = ["get_session", "tune"]
