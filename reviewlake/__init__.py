"""Review analytics and pipeline monitoring on Spark.

Every analysis is a function ``DataFrame -> DataFrame`` built from the
DataFrame API, so Catalyst plans the whole job and nothing is pulled to
the driver.  See README.md for the operator map.
"""

from reviewlake.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
