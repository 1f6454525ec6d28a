"""Training-data pipeline operators.

One module per operator; :mod:`martlight.llm.queries` registers one query per
operator over the ``documents`` / ``pages`` / ``embeddings`` tables.  Nothing
else in the library imports this subpackage.
"""
