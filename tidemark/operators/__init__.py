"""Relational operators over bars, events and memberships."""
