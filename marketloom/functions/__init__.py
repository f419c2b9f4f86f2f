"""Column functions: everything here is a built-in expression, nothing runs in Python workers."""
