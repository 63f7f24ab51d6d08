"""Operators for preparing training data; their queries are in :mod:`lakejobs.llm.queries`."""
