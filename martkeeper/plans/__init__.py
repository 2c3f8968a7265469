"""Compositions: medallion layers, metric-view definitions, question set, query registry."""
