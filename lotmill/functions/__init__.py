"""Column -> Column functions; nothing here leaves whole-stage code generation."""
