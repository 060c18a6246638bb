"""cubewise: long-form statistics pipelines on Spark.

Sources (JSON-stat cubes, declared-schema CSV) -> landing and raw tables ->
staging models -> wide monthly facts -> dashboard queries and data-quality
checks, all as DataFrame expressions. See README.md for the module map.
"""
