"""Pipelines composed from the operators: prepare (fit / apply), train,
evaluate and score."""
