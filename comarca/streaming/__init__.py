"""File streams."""
