"""Readers and sinks. Every reader returns a DataFrame with an explicit row identity where order matters."""
