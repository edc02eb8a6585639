"""Stage plans: silver cleaning, gold features, details, explorations,
dashboards, graph queries and recommenders. Each takes and returns lazy
DataFrames; a ``layer`` is a ``dict[str, DataFrame]`` keyed by table name."""
