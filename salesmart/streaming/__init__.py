"""File-arrival form of the incremental load."""
