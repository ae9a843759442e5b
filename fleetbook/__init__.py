"""fleetbook: rental-business analytics and maintenance jobs on Spark.

Operators are functions from DataFrames to DataFrames (``fleetbook.operators``);
``fleetbook.sources`` holds the table catalogue and readers,
``fleetbook.functions`` the column expressions, ``fleetbook.plans`` the join
and lineage strategies, ``fleetbook.streaming`` the incremental jobs.
"""

__version__ = "0.1.0"
