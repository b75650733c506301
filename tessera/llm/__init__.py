"""Operators of a training-data pipeline: one module per operator, registered as queries in ``queries``."""
