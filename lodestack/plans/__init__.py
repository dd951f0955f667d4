"""Jobs that write: staged commits, conversion, migration, moves, promotion."""
