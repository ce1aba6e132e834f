"""forumlens: Q&A-community analytics as Spark DataFrame, SQL and ML jobs.

Layout
------
sources/    readers and writers (XML, JSON, CSV, text, model store, fixtures)
functions/  Column-expression builders (tag cleaning, text cleaning, hashing)
operators/  DataFrame -> DataFrame operators (joins, scores, sampling, metrics,
            text features, classifiers, mining, graph, recommendation)
plans/      the registered queries and their DuckDB oracle SQL
streaming/  the same operators wired to Structured Streaming sources
"""

__version__ = "0.1.0"
