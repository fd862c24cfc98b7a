"""Pipelines: dimensions, facts, windowed tables and reports."""
