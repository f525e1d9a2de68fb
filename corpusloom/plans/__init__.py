"""End-to-end corpus builds composed from the operators."""
