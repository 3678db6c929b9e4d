"""shelfwise: retail demand, inventory and pricing operators on Spark.

Every operator takes and returns DataFrames built from native Spark
expressions, so Catalyst plans the whole chain and the same code serves
batch frames and Structured Streaming frames.
"""

__version__ = "0.1.0"
