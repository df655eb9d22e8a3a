"""Wiring: session defaults, the registered queries and their SQL oracles."""
