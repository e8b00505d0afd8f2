"""Operators for preparing language-model training text; nothing else in the package imports this one."""
