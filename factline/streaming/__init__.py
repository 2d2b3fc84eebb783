"""File-arrival stream for follow-up material."""
