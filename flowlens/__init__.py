"""flowlens: Spark-native analytics for network connection logs and packet records.

Every public operator is a function ``DataFrame -> DataFrame`` built from Spark's own
expressions (Catalyst plans, whole-stage codegen); the few places that need Python run
as Arrow-batched ``mapInArrow``.
"""

from flowlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
