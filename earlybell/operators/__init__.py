"""DataFrame-to-DataFrame operators; every function is lazy."""
