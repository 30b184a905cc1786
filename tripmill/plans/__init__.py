"""Whole jobs: profile, train, score; and the registered queries."""
