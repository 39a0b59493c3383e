"""Running scripts of several SQL statements."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Quoted text and comments are taken whole, so a semicolon inside them does not split.
_PIECE = re.compile(
    r"""'(?:[^'\\]|\\.|'')*' | "(?:[^"\\]|\\.|"")*" | `(?:[^`]|``)*`
        | --[^\n]* | /\*.*?\*/ | ; | [^'"`;/-]+ | .""",
    re.VERBOSE | re.DOTALL,
)


class ScriptError(RuntimeError):
    """A statement of a script failed; the ones before it have taken effect."""

    def __init__(self, number: int, cause: Exception):
        super().__init__(f"statement {number} failed: {cause}")
        self.number = number


def statements(script: str) -> list[str]:
    """The non-blank statements of a script, split at semicolons outside quotes and comments."""
    found, current, has_code = [], [], False
    for piece in _PIECE.findall(script) + [";"]:
        if piece == ";":
            if has_code:
                found.append("".join(current).strip())
            current, has_code = [], False
            continue
        current.append(piece)
        comment = piece.startswith("--") or (piece.startswith("/*") and len(piece) > 3)
        has_code = has_code or (not comment and bool(piece.strip()))
    return found


def run(spark: SparkSession, script: str) -> int:
    """Run the statements in order, stopping at the first failure; returns how many ran."""
    pending = statements(script)
    for number, statement in enumerate(pending, start=1):
        try:
            spark.sql(statement)
        except Exception as error:
            raise ScriptError(number, error) from error
    return len(pending)
