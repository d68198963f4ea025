"""Composed plans: derived views over the driver tables, stages, reports and the registered queries."""
