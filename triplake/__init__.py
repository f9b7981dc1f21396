"""triplake: a Spark-native library for turning raw trip records into
clean, deduplicated, versioned and leakage-free training datasets.

Every operator is a DataFrame -> DataFrame function built from Catalyst
expressions, so Spark plans, prunes, pushes down and distributes the work.
"""

__version__ = "0.1.0"
