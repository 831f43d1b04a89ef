"""provisio: procurement and inventory analytics as Spark DataFrame jobs.

Every public operator is a function ``DataFrame(s) -> DataFrame``. Nothing is
collected to the driver except scalar subqueries and bounded model metadata.
"""

from provisio.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
