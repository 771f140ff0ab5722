"""arrivalgate: set-based load-readiness and refresh-audit engine on PySpark.

Every public operator is a pure function ``DataFrame -> DataFrame`` (lazy);
evaluation time (``now``), limits and message texts are arguments, never
read from the clock inside an operator.
"""

from arrivalgate.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
