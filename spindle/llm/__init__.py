"""Operators for preparing large training corpora.

One module per operator; ``queries`` registers them for the driver.  Nothing else
in the library imports this subpackage.
"""
