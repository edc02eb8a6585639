"""Batch recommenders for all users / products (R1-R27): content TF-IDF,
implicit ALS, cold start, also-bought, hybrid re-ranker, router and offline
evaluation. Requests are DataFrames of ids and context, never single ids."""
