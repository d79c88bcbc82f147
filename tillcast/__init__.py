"""tillcast: a Spark-native sales / weather / event analytics engine.

Every operator is a DataFrame -> DataFrame function. Time is always an explicit
``as_of`` parameter; nothing reads the wall clock.
"""

__version__ = "0.1.0"
