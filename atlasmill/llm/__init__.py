"""Operators of a training-data pipeline: texts in, decisions out, one module an operator."""
