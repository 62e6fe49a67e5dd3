"""Training-data operators: filtering, de-duplication, extraction, mixing.

Nothing outside this package imports it; ``__spark_entry__`` registers its
queries only when it is present.
"""
