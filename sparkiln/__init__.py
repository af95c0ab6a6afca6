"""sparkiln: text, trip and statistics analytics as Spark DataFrame operators.

Every public operator takes DataFrames/Columns and returns DataFrames/Columns.
The execution engine is Spark itself: plans are declared with the DataFrame
and SQL APIs so Catalyst can push filters, prune columns and pick join
strategies.  Driver-side work is limited to scalars and k-row centroid tables.
"""

__version__ = "0.1.0"
