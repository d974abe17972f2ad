"""Operators for preparing training data, one module per operator.

Nothing outside this folder imports it; `queries` holds one check query per operator.
"""
