"""Operators of a training-data pipeline over ``documents`` and its sister tables.

One module per operator; ``queries.py`` registers them.  Nothing outside this
package imports it.
"""
