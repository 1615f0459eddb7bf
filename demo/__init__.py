"""Demonstration inputs derived from the driver tables, and the registered queries over them."""
