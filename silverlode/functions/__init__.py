"""Column functions: small expressions that stay inside Catalyst."""
