"""Operators for preparing training text: de-duplication, decontamination, scoring, tokens, packing, sharding."""
