"""PySpark engine for curating evidence-grounded training tasks."""
