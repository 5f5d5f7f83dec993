"""DataFrame -> DataFrame transforms, the same for batch and streaming input."""
