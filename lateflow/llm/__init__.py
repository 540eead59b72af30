"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; its queries are registered in
``lateflow.llm.queries`` and added by the driver contract only when it is present.
"""
