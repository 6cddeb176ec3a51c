"""Readers: files, tables, and message streams. Every schema is declared."""
