"""DataFrame-to-DataFrame steps; the same functions serve batch and streaming frames."""
