"""Operators for training-data pipelines. One module an operator; ``queries`` registers them, nothing outside imports this."""
