"""Operators for preparing training text at scale.

One module per operator; ``queries`` registers them, ``oracle`` has the SQL of
those that SQL can express.  Nothing outside this package imports it.
"""
