"""Wide entity tables from long observations, on PySpark."""
