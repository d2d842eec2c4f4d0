"""Training-data operators for large text corpora.

One module per operator, each with its own general interface; ``queries.py``
registers one ``opN_<name>`` query per operator over the whole given tables.
Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
