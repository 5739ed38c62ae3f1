"""Whitespace tokens, cleanup and names, as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token separators. Spelled out because \s differs between regex engines.
SEPARATORS = r" \t\n\r\f"
TOKEN = f"[^{SEPARATORS}]+"
SPACED_TOKEN = f"[{SEPARATORS}]*[^{SEPARATORS}]+"

# Everything Python calls white space, for trimming both ends.
WHITE_SPACE = "".join(c for c in map(chr, range(0x10000)) if c.isspace())

NOT_WORD = r"[^\p{L}\p{N}]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_part(number: Column, width: int, kind: str = "bigint") -> Column:
    """Number of the range of ``width`` values that holds an integer, exactly."""
    n, w = number.cast(kind), F.lit(width).cast(kind)
    return F.call_function("div", n - F.pmod(n, w), w)


def token_count(text: Column) -> Column:
    """Number of whitespace-separated tokens; null for a null text."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint")


def token_truncate(text: Column, n: int = 4000) -> Column:
    """First ``n`` tokens with their spacing; unchanged when within ``n``."""
    # n + 1 tokens need at least 2n + 1 characters, so most texts skip the regex.
    pieces = F.regexp_extract_all(text, F.lit(SPACED_TOKEN), F.lit(0))
    return F.when(F.length(text) <= 2 * n, text).otherwise(
        bind(
            pieces,
            lambda p: F.when(F.size(p) <= n, text).otherwise(
                F.array_join(F.slice(p, 1, n), "")
            ),
        )
    )


def newline_cleanup(text: Column) -> Column:
    """Runs of three or more newlines become two; both ends are trimmed."""
    return F.btrim(F.regexp_replace(text, "\n{3,}", "\n\n"), F.lit(WHITE_SPACE))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order, with repeats."""
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def name_normalise(name: Column) -> Column:
    """User name to identifier: drop the last ``@`` part, non-word runs -> ``_``."""
    # An @ in first place is no separator.
    local = F.regexp_replace(name, r"(?s)^(.+)@[^@]*\z", "$1")
    return F.regexp_replace(local, r"[^\p{L}\p{N}_]+", "_")


def name_ascii(name: Column) -> Column:
    """Every character outside A-Z, a-z, 0-9 becomes one ``_``."""
    return F.regexp_replace(name, "[^A-Za-z0-9]", "_")
