"""edgeframe: edge-list and 1-D clustering analytics as Spark DataFrame plans.

Every operator is a function from DataFrames to a DataFrame.  Catalyst plans
the work; the cluster executes it.  The only values that ever reach the driver
are bounded by a parameter (K centroids, one convergence flag, one scalar).
"""

__version__ = "0.1.0"
