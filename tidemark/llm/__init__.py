"""Operators for training-data text: filters, deduplication, tokens, scoring. Nothing else imports this subpackage."""
