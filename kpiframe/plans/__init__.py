"""Plan-level policy and checks: size-bounded broadcasts (``broadcast``) and
physical-plan inspection (``inspect``)."""
