"""Named end-to-end queries composed from the operators."""
