"""Corpus operators for training data (see README, section "llm").

Nothing outside this subpackage imports it; its queries are in
:mod:`marquee.llm.queries`.
"""
