"""End-to-end audits and migrations composed from the operators."""
