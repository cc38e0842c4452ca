"""Registered queries over the warehouse tables and their SQL equivalents."""
