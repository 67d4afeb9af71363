"""SQL text for expressions that are made per monitored column.

Building a wide aggregate from Python column objects costs several driver round trips per column; a
table's aggregates are therefore given to Spark as one text. Names and values only ever enter it
through the two functions here.
"""

from __future__ import annotations


def sql_name(name: str) -> str:
    """A column name or one part of a table name, quoted."""
    if "${" in name:
        raise ValueError(f"a name that SQL text would expand: {name}")
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str | None) -> str:
    """A text literal, quoted and escaped."""
    if value is None:
        return "NULL"
    # A dollar sign is escaped because ``${…}`` would be expanded even inside a literal.
    escapes = {"\\": "\\\\", "'": "\\'", "\n": "\\n", "\r": "\\r", "\0": "\\0", "$": "\\u0024"}
    return "'" + "".join(escapes.get(c, c) for c in value) + "'"


def sql_struct(**fields: str) -> str:
    """A struct of SQL expressions."""
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"
