"""Incremental star-schema maintenance and reporting on PySpark."""
