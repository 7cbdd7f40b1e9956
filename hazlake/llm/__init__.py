"""Operators for preparing training text: each module holds one, ``checks`` their registered queries."""
