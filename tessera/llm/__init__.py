"""Training-data operators: deduplication, search, tokenisation, language and mixing.

Nothing outside this subpackage imports it.  ``queries`` registers one query per operator.
"""
