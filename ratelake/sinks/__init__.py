"""Sinks: tables that grow by appends, JSON dumps, and message topics."""
