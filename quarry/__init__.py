"""quarry: statistics, feature selection and model evaluation as Spark DataFrame operators.

Every operator takes Spark DataFrames and returns Spark DataFrames. Heavy work
stays in Spark plans (aggregations, windows, joins) or Arrow batches inside
tasks; the driver only ever sees state tables bounded by
features x classes x bins.
"""

from quarry.session import get_spark, ensure_checkpoint_dir, cut_lineage

__all__ = ["get_spark", "ensure_checkpoint_dir", "cut_lineage"]
