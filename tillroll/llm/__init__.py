"""Operators for preparing language-model training data.

Each module holds one operator with its own interface; ``queries`` registers
one query per operator over the ``documents`` table. Nothing outside this
package imports it.
"""
