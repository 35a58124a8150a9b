"""File streams through the batch operators."""
