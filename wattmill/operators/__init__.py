"""DataFrame-to-DataFrame steps. All lazy."""
