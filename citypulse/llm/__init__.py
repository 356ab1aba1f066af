"""Operators for building language-model training corpora, one module per operator.

Each module has a general DataFrame operator; :mod:`citypulse.llm.queries`
registers the thin ``opN_<name>`` queries over the driver's tables. Nothing
outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
