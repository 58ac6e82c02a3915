"""All registered queries of the subpackage and the SQL of those it can express."""

from . import queries_models, queries_native, queries_pairs, queries_vocabulary

QUERIES = {**queries_models.QUERIES, **queries_native.QUERIES, **queries_pairs.QUERIES, **queries_vocabulary.QUERIES}
ORACLE_SQL = {**queries_native.ORACLE_SQL, **queries_pairs.ORACLE_SQL, **queries_vocabulary.ORACLE_SQL}
