"""Readers for landed registers, lookups and boundaries."""
