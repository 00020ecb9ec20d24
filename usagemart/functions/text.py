"""Names and labels."""

from __future__ import annotations


def full_name(first: str, last: str) -> str:
    """First and last name with one space; a missing part is empty and the space stays."""
    return f"concat(coalesce({first}, ''), ' ', coalesce({last}, ''))"


def first_given(*texts: str) -> str:
    """The first text that is neither NULL nor empty."""
    return f"coalesce({', '.join(f'''nullif({t}, '')''' for t in texts)})"


def aliased(expressions: dict[str, str]) -> list[str]:
    """``{name: expression}`` as select items."""
    return [f"{expression} AS {name}" for name, expression in expressions.items()]
