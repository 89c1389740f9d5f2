"""End-to-end plans composed from the operators."""
