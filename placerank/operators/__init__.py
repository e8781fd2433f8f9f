"""DataFrame -> DataFrame operators, all lazy unless the docstring says otherwise."""
