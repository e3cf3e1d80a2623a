"""Operations of a training-data pipeline, as Spark jobs.

Each module holds one operator with its own interface; ``queries`` wires the
operators to the given tables. Nothing else in the library imports this package.
"""
