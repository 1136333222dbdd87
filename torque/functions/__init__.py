"""Column-level building blocks: windows, currency normalisation, JSON checks."""
