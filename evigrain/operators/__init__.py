"""Operators over task records: gates, alignment, selection and review."""
