"""Validation queries over the shared test tables and independent SQL that states what they must return."""
