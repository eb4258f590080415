from strataq.functions.patterns import normalise_like

__all__ = ["normalise_like"]
