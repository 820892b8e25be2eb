"""DataFrame-to-DataFrame operators: flatten, dedupe, widths, rejects, skew-safe join."""
