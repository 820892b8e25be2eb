"""Column expressions: award keys, byte-width truncation, link and file names."""
