"""pulsekit: Spark-native analytics for wearable health measurements.

Every operator is a DataFrame / Spark SQL expression (or MLlib stage), so the
work is planned by Catalyst and executed on the cluster. See README.md for the
operator map.
"""

from pulsekit.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
