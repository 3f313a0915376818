"""Learners that Spark ML has no equal for."""
