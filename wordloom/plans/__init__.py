"""Whole jobs: the construction cycle, the analyses, and the registered queries."""
