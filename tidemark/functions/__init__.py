from tidemark.functions import dates, fixed_values, scalars

__all__ = ["dates", "fixed_values", "scalars"]
