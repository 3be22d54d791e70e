"""Token lists (C1) and token replacement.

Both compile to built-in string expressions.  Replacement is one Java-regex
``regexp_replace`` whose alternation keeps the caller's token order (the
first listed token that matches wins); each run of consecutive one-character
tokens becomes a single character class, which is exact (one character can
match only one of them) and measured faster than both ``translate`` and a
plain alternation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with a meaning in Java regular expressions, and
# inside a character class.
_REGEX_META = set("\\^$.|?*+()[]{}")
_CLASS_META = set("\\[]^-&")


def parse_token_list(text: str, delimiter: str = "|") -> list[str]:
    """C1 on a constant: split on a literal delimiter the way Java's
    ``String.split`` does -- trailing empty strings are dropped, and a text
    with no delimiter comes back whole."""
    if delimiter not in text:
        return [text]
    parts = text.split(delimiter)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def split_tokens(col: Column | str, delimiter: str = "|") -> Column:
    """C1 on a column: same rule as :func:`parse_token_list`, as an
    expression (``split`` keeps trailing empties, so they are sliced off)."""
    c = F.col(col) if isinstance(col, str) else col
    arr = F.split(c, java_regex_literal(delimiter), -1)
    # 1-based position, from the end, of the last non-empty token (0 = none)
    last = F.array_position(F.reverse(F.transform(arr, lambda x: x != F.lit(""))), F.lit(True))
    keep = F.when(last == 0, F.lit(0)).otherwise(F.size(arr) - last + 1)
    no_delim = F.instr(c, delimiter) == 0
    return F.when(no_delim, F.array(c)).otherwise(F.slice(arr, F.lit(1), keep.cast("int")))


def java_regex_literal(token: str) -> str:
    """A token as a Java regex matching exactly that text (each special
    character escaped; unlike ``\\Q...\\E`` this also survives a ``\\E``)."""
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in token)


def java_class_literal(chars: list[str]) -> str:
    """A character class matching exactly the given single characters."""
    return "[" + "".join("\\" + ch if ch in _CLASS_META else ch for ch in chars) + "]"


def token_pattern(tokens: list[str]) -> str:
    """Alternation of the tokens in list order; consecutive one-character
    tokens are merged into one class."""
    parts: list[str] = []
    run: list[str] = []
    for t in tokens:
        if len(t) == 1:
            run.append(t)
            continue
        if run:
            parts.append(java_class_literal(run) if len(run) > 1 else java_regex_literal(run[0]))
            run = []
        parts.append(java_regex_literal(t))
    if run:
        parts.append(java_class_literal(run) if len(run) > 1 else java_regex_literal(run[0]))
    return "|".join(parts)


def java_replacement_literal(text: str) -> str:
    """A replacement string taken literally (``$`` and ``\\`` escaped)."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def replace_tokens(col: Column | str, tokens: list[str] | str, replacement: str = "@",
                   delimiter: str = "|") -> Column:
    """Replace every occurrence of any token by ``replacement``.

    ``tokens`` is a list or a delimited string (split by C1).  Empty tokens
    are dropped (they would match between all characters).  Null stays null.
    """
    if isinstance(tokens, str):
        tokens = parse_token_list(tokens, delimiter)
    ordered = list(dict.fromkeys(t for t in tokens if t != ""))
    c = F.col(col) if isinstance(col, str) else col
    if not ordered:
        return c
    return F.regexp_replace(c, token_pattern(ordered), java_replacement_literal(replacement))
