"""fieldloom: derive catalogue fields from per-category rules with PySpark."""
