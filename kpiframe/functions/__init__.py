"""Column-level building blocks: periods (``period``), growth arithmetic
(``growth``) and report text (``text``). All are built-in expressions."""
