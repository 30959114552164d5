"""Operators from DataFrame to DataFrame. All are lazy unless they say otherwise."""
