"""DataFrame -> DataFrame steps.  None of them acts (no write, no collect)."""
