"""Whole flows built from the operators: stage, publish, dashboard."""
