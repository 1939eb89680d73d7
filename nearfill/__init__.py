"""nearfill — Spark-native sentinel imputation and nearest-neighbour classification.

Every operator takes and returns Spark DataFrames.  Fitted models are small
DataFrames (scaler rows, centres, medians) plus the scaled reference data; the
only values brought to the driver are bounded scalars (class lists, quotas,
chosen k, pivot/centre coordinates whose size is fixed by parameters).
"""

__all__ = ["operators", "sources", "functions", "plans", "streaming"]
__version__ = "0.1.0"
