"""What the mart builds and answers."""
