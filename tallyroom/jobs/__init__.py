"""Jobs for spark-submit, one per step: extract, transform, load, dashboard."""
