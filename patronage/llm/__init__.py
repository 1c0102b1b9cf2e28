"""Operators for training-data text: one module per operator, nothing else imports them."""
