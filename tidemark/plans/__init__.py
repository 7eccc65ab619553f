"""The model build composed from the operators, and the registered queries."""
