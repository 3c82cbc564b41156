"""Column-level helpers: vector algebra, text rules and portable hashes."""
