"""Query compositions over the supplied tables; see ``registry``."""

from qaspark.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401


def load_all():
    """Import every query module so its ``register`` calls run."""
    from qaspark.plans import q_chat, q_corpus, q_eval, q_io, q_load, q_split, q_stream  # noqa: F401

    return QUERIES, ORACLE_SQL
