"""DataFrame-to-DataFrame transforms, usable in batch and in streams."""
