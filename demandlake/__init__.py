"""demandlake: a retail event lake and demand-forecast pipeline on Spark.

Bronze -> silver -> gold feature marts, training sets, distributed metrics,
hurdle-model training and batch/stream scoring, all as DataFrame jobs.
"""

__all__ = ["session"]
