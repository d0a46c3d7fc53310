"""Relational operators: DataFrame in, DataFrame out.

They only describe the result. Where the plan depends on the data, a small
measurement runs first: the hot keys of the rows (skew.py) or the number of
versions per member of a small dimension (lookup.py).
"""
