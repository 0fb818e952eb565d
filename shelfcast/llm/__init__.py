"""Operators for preparing training data, their queries and SQL; nothing else imports this package."""
