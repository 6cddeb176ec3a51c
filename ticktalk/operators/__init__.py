"""Operators over whole tables, built by composing DataFrame operations."""
