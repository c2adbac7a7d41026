"""Whole jobs a user calls, composed from the operators."""
