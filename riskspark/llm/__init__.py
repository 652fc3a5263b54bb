"""Operations of a training-data pipeline over text, pages and vectors.

Nothing outside this folder imports it; ``__spark_entry__`` registers its
queries only where it can be imported.
"""
