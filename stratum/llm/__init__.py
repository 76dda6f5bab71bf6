"""Operators for preparing training data: packing, de-duplication, mixing,
quality selection, search and token output. Nothing outside imports this."""
