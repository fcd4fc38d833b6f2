"""Operators for preparing training text at scale, and the queries that apply them.

Nothing outside this subpackage imports it. The operator modules are named
after what they do; `queries` registers one query per operator.
"""
