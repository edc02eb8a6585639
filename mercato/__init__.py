"""mercato: a Spark-native marketplace analytics engine.

Every stage (bronze cleaning, gold features, detail tables, explorations,
dashboards, graph queries, recommenders, evaluation) is a lazy
DataFrame -> DataFrame function; Spark plans, distributes and scales it.
"""

__version__ = "0.1.0"
