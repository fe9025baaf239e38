"""File and table reads, and table writes."""
