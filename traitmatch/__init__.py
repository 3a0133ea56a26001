"""traitmatch: talent matching as Spark DataFrame operators.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects (or
``Column`` expressions for the scalar helpers); nothing is collected to the
driver inside an operator.
"""

from traitmatch.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
