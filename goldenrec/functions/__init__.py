"""Column-level building blocks (pure ``Column`` expressions)."""

from goldenrec.functions import hashing, normalize  # noqa: F401
