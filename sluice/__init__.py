"""sluice — Spark-native batch and streaming ETL operators.

Every operator is a plain ``DataFrame -> DataFrame`` function (or a writer that
takes a DataFrame) so Catalyst plans the whole job: filters reach the Parquet
scan, aggregations run partial/final, and nothing is collected to the driver.
"""

from sluice.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
