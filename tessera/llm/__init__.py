"""Training-data operators: near-duplicates, archives, classifiers, scanners, tokenizers, packing and filters.

Nothing outside this subpackage imports it. ``queries`` registers one query per
operator; each operator module has its own general interface.
"""
