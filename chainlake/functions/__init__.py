"""Column functions. All are compositions of built-ins, so they stay inside code generation."""
