"""Column helpers and reusable relational building blocks."""
