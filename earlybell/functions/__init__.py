from earlybell.functions import scalars

__all__ = ["scalars"]
