"""Table definitions, raw readers, and the table layers."""
