"""skein: discussion-corpus analytics on Spark.

Modules: ``sources`` (files and table adapters, sinks), ``functions`` (text,
predicates, user functions), ``operators`` (rows, ordered, pairs, threads,
stats, vocabulary, features, skew, indexing), ``plans`` (explorer, programs,
registered queries), ``streaming`` (Structured Streaming forms).
"""

__version__ = "0.1.0"
