"""Operators for large training-data pipelines (one module per operator) and
their registered queries (``queries.py``)."""
