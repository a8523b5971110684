"""Compositions of operators: gold marts and the batch pipeline."""
