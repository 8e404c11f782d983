"""Jobs that join the operators and read and write tables."""
