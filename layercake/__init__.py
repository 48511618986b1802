"""layercake: layered-table cleaning, modelling and quality checks on Spark.

Every operator takes and returns DataFrames (or streams) built from Spark
built-ins; see README.md for the operator map.
"""

from layercake.session import ensure_checkpoint_dir, local_session, scratch_path

__all__ = ["ensure_checkpoint_dir", "local_session", "scratch_path"]
