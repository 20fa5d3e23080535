"""Import plans: each turns one feed into merged target tables inside a Workspace."""
