"""Text expressions with Python's string semantics, as JVM-side Spark expressions.

None of them uses a Java regex: a character class over all Unicode white space runs at a few MB/s
per core, ``trim`` and one-character ``split`` many times faster, and they stay short enough for the
generated code to be compiled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters for which Python's str.isspace() holds.
_SPACE_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE = "".join(map(chr, _SPACE_CODES))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """``str.strip()``: white space of any kind off both ends."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """True for null, empty and white-space-only text; never null."""
    return F.coalesce(strip(c), F.lit("")) == ""


def tokens(c: Column | str) -> Column:
    """Lower-cased words between white space, repeats kept; punctuation stays on the word."""
    spaced = F.translate(F.lower(_col(c)), WHITESPACE, " " * len(WHITESPACE))
    return F.array_remove(F.split(spaced, " "), "")


def token_set(c: Column | str) -> Column:
    return F.array_distinct(tokens(c))


def word_count(c: Column | str) -> Column:
    return F.array_size(tokens(c))


def overlap(a: Column | str, b: Column | str) -> Column:
    """Jaccard similarity of two token arrays; 0.0 when either is empty, null when either is null.

    The union is |A| + |B| - |A and B|, so only the intersection is built. Repeats are dropped, so
    plain token arrays will do. Bind the arrays to columns first: each is read more than once here.
    """
    a, b = _col(a), _col(b)
    either_empty = (F.array_size(a) == 0) | (F.array_size(b) == 0)
    common = F.array_size(F.array_intersect(a, b))
    # Bound to a variable of a one-element array, so that the intersection is made once.
    sizes = F.array_size(F.array_distinct(a)) + F.array_size(F.array_distinct(b))
    share = F.get(F.transform(F.array(common), lambda c: c / (sizes - c)), F.lit(0))
    return F.when(either_empty, F.lit(0.0)).otherwise(share)


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Jaccard similarity of the word sets of two texts."""
    return overlap(tokens(a), tokens(b))


def length_ratio(chosen: Column | str, rejected: Column | str) -> Column:
    return F.length(_col(rejected)) / F.greatest(F.length(_col(chosen)), F.lit(1))


def two_decimals(c: Column | str) -> Column:
    """Like Python's ``.2f``: ties to even, no thousands separator."""
    return F.call_function("format_number", _col(c), F.lit("0.00"))


def or_default(c: Column | str, default) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def mentions(c: Column | str, lowered: tuple[str, ...] = (), raw: tuple[str, ...] = ()) -> Column:
    """True if the text holds a ``lowered`` marker in any case or a ``raw`` marker as written."""
    text = or_default(c, "")
    found = F.lit(False)
    for marker in lowered:
        found = found | F.lower(text).contains(marker)
    for marker in raw:
        found = found | text.contains(marker)
    return found
