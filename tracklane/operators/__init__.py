"""DataFrame → DataFrame operators. Column names are arguments throughout.

Orderings are ascending with NULL last, and every ordering ends in tie-break
columns, so results do not depend on how rows are spread over tasks.
"""
