"""Column functions over text, cells and note formats."""
