"""Named questions composed from the operators."""
