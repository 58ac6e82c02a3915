"""starmart: a Spark-native star-schema build.

Raw arrival records, code lists and monthly rates are cleaned with DataFrame
expressions, shaped into one fact and three dimensions, merged into published
tables (insert-only fact, type-1 dimensions), checked, and queried.
"""

__all__ = ["schemas", "session"]
