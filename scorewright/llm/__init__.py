"""Training-data pipeline operators (quality rules, language-model scores, secrets, chat transcripts,
language ID, exact and near dedup, licences, BPE, packing).

Nothing else in the library imports this subpackage.  Operators live in one module each; the registered
queries and their SQL are in ``queries.py``.
"""
