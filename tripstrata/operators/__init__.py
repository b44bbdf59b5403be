"""DataFrame-to-DataFrame steps. All are lazy."""
