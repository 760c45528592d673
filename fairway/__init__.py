"""fairway: round-level golf scoring analytics on Spark.

Event difficulty, course factor and a difficulty-weighted rolling form
index, expressed as composable ``DataFrame -> DataFrame`` transforms.
"""

__version__ = "0.1.0"
