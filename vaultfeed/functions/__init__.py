"""Column functions: accounting periods, codes and flags, money."""
