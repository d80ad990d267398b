"""Operators for preparing training corpora at scale.

Each module holds one operator with its own general interface; `queries`
registers one query per operator over the `documents` / `pages` tables.
Nothing outside this subpackage imports it.
"""
