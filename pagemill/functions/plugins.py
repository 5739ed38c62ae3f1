"""Plug points for Python models: Arrow batches in and out, one set-up per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def series_udf(fn: Callable[[pa.Array], pa.Array], returns: str):
    """Column function from a function of a batch of values."""
    return iterator_udf(lambda: fn, returns)


def iterator_udf(setup: Callable[[], Callable[[pa.Array], pa.Array]], returns: str):
    """Column function from ``setup()``, which is run once per task and returns a function
    of a batch; for models that load slowly."""

    @F.arrow_udf(returns)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = setup()
        for values in batches:
            yield fn(values)

    return run


def _relisted(lists: pa.Array, flat: pa.Array) -> pa.Array:
    """``flat`` cut like ``lists``, null where that is null."""
    lengths = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
    cut = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), flat)
    return pc.if_else(lists.is_valid(), cut, pa.scalar(None, cut.type))


class ModelTokens:
    """Tokenizer for the chunk operators from ``encode`` and ``decode`` functions.

    ``setup`` runs once per task and returns the pair: ``encode`` takes a list of texts
    and gives a list of token lists, ``decode`` does the reverse. Tokens are counted
    section by section and added up, so a merge across a section border is not seen.
    """

    def __init__(self, setup: Callable[[], tuple[Callable, Callable]]):
        self.setup = setup

    def count_each(self, texts: Column) -> Column:
        return self._counted(texts, True)

    def count(self, text: Column) -> Column:
        return self._counted(text, False)

    def _counted(self, texts: Column, nested: bool) -> Column:
        setup = self.setup

        def counter():
            encode, _ = setup()

            def count(values: pa.Array) -> pa.Array:
                flat = values.flatten() if nested else values
                known = flat.is_valid()
                sizes = iter([len(t) for t in encode(flat.filter(known).to_pylist())])
                counts = pa.array([next(sizes) if k else None for k in known.to_pylist()], pa.int64())
                return _relisted(values, counts) if nested else counts

            return count

        return iterator_udf(counter, "array<bigint>" if nested else "bigint")(texts)

    def truncate_each(self, texts: Column, above: Column, n: int) -> Column:
        """The texts, those that are ``above`` cut to ``n`` tokens; others are not encoded."""
        setup = self.setup

        def cutter():
            encode, decode = setup()

            def cut(values: pa.Array) -> pa.Array:
                flat = values.flatten()
                text, long = flat.field("text"), pc.fill_null(flat.field("above"), False)
                shorter = iter(decode([tokens[:n] for tokens in encode(text.filter(long).to_pylist())]))
                out = [next(shorter) if a else t for t, a in zip(text.to_pylist(), long.to_pylist())]
                return _relisted(values, pa.array(out, pa.string()))

            return cut

        marked = F.zip_with(texts, above, lambda t, a: F.struct(t.alias("text"), a.alias("above")))
        return iterator_udf(cutter, "array<string>")(marked)
