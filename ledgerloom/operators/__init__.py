"""DataFrame -> DataFrame operators. Each is a composition of built-in relational operators."""
