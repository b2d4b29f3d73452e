"""Training-data operators (ten operators and their queries).

Nothing else in the repository imports this package; ``__spark_entry__`` adds
its queries when it is present.
"""
