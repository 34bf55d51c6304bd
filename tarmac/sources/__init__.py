"""Readers and writers: monthly reports, archives, warehouse tables."""
