"""Operators of a training-data pipeline, one module per operator.

Nothing outside this folder imports it; its queries are in
``tidepool.llm.queries`` and its tests in ``tests/llm``.
"""
