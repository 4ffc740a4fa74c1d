"""Operators for preparing language-model training data.

Thirteen corpus operators (chat formatting, benchmark decontamination, HTML
extraction, personal data, byte-level repeat removal, sequence packing,
secret scans, near-duplicate detection, word-level repeat removal, quality
rules, vector codes, approximate nearest neighbours, ranked lexical search).
Nothing else in the library imports this subpackage.
"""
