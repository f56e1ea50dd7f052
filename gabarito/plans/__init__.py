"""The four jobs, each one declarative plan over the operators."""
