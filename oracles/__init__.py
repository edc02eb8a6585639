"""Independent DuckDB/ANSI SQL statements of each registered query, used as
the correctness oracle (the driver's views: region nation customer supplier
part orders lineitem ...)."""
