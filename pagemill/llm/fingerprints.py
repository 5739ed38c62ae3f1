"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

Two sketches compare whatever the sizes of their documents, and the sketch of a union is
the union of the sketches. A text with few such hashes keeps its ``FLOOR`` smallest
instead, so short texts are compared in full; ``bound`` tells up to where a sketch is
complete, and only that range is compared.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import bind
from .common import positions, word_list

SHINGLE = 5
FLOOR = 32
#: Signed hashes up to here are the lowest quarter of the range.
KEEP = -(1 << 63) + (1 << 62)
_LAST = (1 << 63) - 1


def shingle_hashes(text: Column, width: int = SHINGLE) -> Column:
    """Hashes of all runs of ``width`` words; a shorter text is one run; none without words."""
    runs = lambda w: F.when(F.size(w) < width, F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(
        F.array().cast("array<bigint>"))).otherwise(F.transform(positions(F.size(w) - (width - 1)), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(width)])))
    return bind(word_list(text), runs)


def sketch(text: Column, width: int = SHINGLE) -> Column:
    """Sorted distinct hashes that the text keeps; empty for a text without words."""
    low = lambda h: F.array_distinct(F.filter(h, lambda x: x <= KEEP))
    kept = lambda h: bind(low(h), lambda k: F.when(F.size(k) >= FLOOR, F.sort_array(k)).otherwise(
        F.slice(F.sort_array(F.array_distinct(h)), 1, FLOOR)))
    return bind(shingle_hashes(text, width), kept)


def bound(sketch: Column) -> Column:
    """Largest hash up to which the sketch has all hashes of its text."""
    return F.when(F.size(sketch) < FLOOR, F.lit(_LAST)).otherwise(F.greatest(F.lit(KEEP), F.array_max(sketch)))


def _shared(a: Column, b: Column, result) -> Column:
    def compared(limit: Column) -> Column:
        upto = lambda s: F.filter(s, lambda x: x <= limit)
        return bind(F.struct(upto(a).alias("a"), upto(b).alias("b")), lambda s: result(
            F.size(F.array_intersect(s["a"], s["b"])), F.size(s["a"]), F.size(s["b"])))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(
        bind(F.least(bound(a), bound(b)), compared))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; empty in empty is 1; null where
    ``a`` has no hash in the range that both keep."""
    return _shared(a, b, lambda n, na, nb: n / F.nullif(na, F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """The larger of both containments, 0 to 1; null where one of them is not known."""
    return _shared(a, b, lambda n, na, nb: n / F.nullif(F.least(na, nb), F.lit(0)))


def merged(a: Column, b: Column) -> Column:
    """Sketch of two texts taken together."""
    limit = F.least(bound(a), bound(b))
    both = F.sort_array(F.array_union(a, b))
    return bind(limit, lambda l: F.filter(both, lambda x: x <= l))


def written(sketch: Column) -> Column:
    """The sketch as text, 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), "")
