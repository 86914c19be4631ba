"""Operators for preparing training data: one module per operator, registered in ``catalog``."""
