"""Language identification by averaged subword embeddings.

A text is the mean of the embeddings of its hashed letter groups (two and three
characters, word borders included); a linear softmax over it gives the language.
``train`` fits both tables by stochastic gradient descent in numpy on a bounded sample
and scales the scores on rows set aside for that. ``predict`` reads whole texts: embedding
and output layer are both linear, so they are multiplied once and a text needs one look-up
per letter group.

A score only tells the learned languages from each other, so it rejects nothing. What is
rejected are texts whose letter groups are rare in every learned language (``rarity``),
rarer than those of nearly all rows set aside. Each group counts by the language that has
it most, so a text of two learned languages is as familiar as one of either.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import values_of
from .hashing import constants, groups

BUCKETS = 1 << 16
DIMENSIONS = 16
LANGUAGES = 200        # most frequent ones that are learned
PER_LANGUAGE = 600     # rows of each that are sampled for the fit, in expectation
EPOCHS = 6
RATE = 0.5
CALIBRATE = 5          # every fifth sampled row calibrates instead
FALSE_REJECTIONS = 0.002
DEVIATIONS = 3         # by so many standard errors a short text may look rarer by chance
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_groups(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``text number, bucket`` of every letter group: pairs with a letter in them and
    triples around a letter; anything but letters is a word border."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in low])  # its first border, then its characters
    letter = _letters()[codes]
    value = np.where(letter, codes, 0).astype(np.uint64)
    a, b, c, d = constants(4, 5)
    pair = (value[:-1] * a + value[1:] * b) * d
    triple = (value[:-2] * a + value[1:-1] * b + value[2:] * c) * c
    has_pair, has_triple = np.flatnonzero(letter[:-1] | letter[1:]), np.flatnonzero(letter[1:-1])
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    return (np.concatenate((owner[has_pair], owner[has_triple])),
            np.concatenate((pair[has_pair] >> shift, triple[has_triple] >> shift)).astype(np.int64))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray       # BUCKETS x languages: embedding times output layer
    bias: np.ndarray
    scale: float
    rarity: np.ndarray      # BUCKETS: minus log of the share in the language that has it most
    least: float            # a lower familiarity is rejected

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of each language, the number of letter groups, and familiarity."""
        owner, bucket = letter_groups(texts)
        n = np.bincount(owner, minlength=len(texts))
        sums = np.stack([np.bincount(owner, self.table[bucket, k], len(texts)) for k in range(len(self.languages))], 1)
        rare = self.rarity[bucket]
        some = np.maximum(n, 1)
        mean, square = (np.bincount(owner, x, len(texts)) / some for x in (rare, rare * rare))
        return _softmax((sums / some[:, None] + self.bias) * self.scale), n, _familiarity(mean, square, some)


def _familiarity(mean, square, n):
    """Minus the mean rarity of ``n`` letter groups, with what chance may add to it."""
    return DEVIATIONS * np.sqrt(np.maximum(square - mean * mean, 0) / n) - mean


def _rarity(data: list[tuple]) -> np.ndarray:
    """Rarity of each letter group, from the rows ``language, aside, buckets, counts`` by
    language. Groups not seen in a language share as much as one count each, or as all
    that were seen if these are fewer."""
    most = np.zeros(BUCKETS)
    for _, rows in itertools.groupby(data, lambda row: row[0]):
        seen = np.zeros(BUCKETS)
        for _, _, bucket, n in rows:
            seen[bucket] += n
        extra = min(1.0, seen.sum() / BUCKETS)
        most = np.maximum(most, (seen + extra) / (seen.sum() + extra * BUCKETS))
    return -np.log(most)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, counts = [], []
        for texts in groups(values_of(batch, "text")):
            for one in texts:
                bucket, n = np.unique(letter_groups([one])[1], return_counts=True)
                found.append(bucket)
                counts.append(n)
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("aside"), pa.array(found, pa.list_(pa.int32())),
                                          pa.array(counts, pa.list_(pa.int32()))], ["lang", "aside", "buckets", "counts"])


def sampled(labelled: DataFrame, id: str, text: str, lang: str, per_language: int) -> DataFrame:
    """``lang, aside, buckets, counts`` of about ``per_language`` rows of each language.

    A hash of id and text decides, so reruns take the same rows. A row has at most
    ``BUCKETS`` entries, however long its text.
    """
    rows = labelled.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.rlike("text", F.lit(r"\p{L}")))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return rows.limit(0).select("lang", F.lit(False).alias("aside"), "text").mapInArrow(
            _counted, "lang string, aside boolean, buckets array<int>, counts array<int>")
    share = F.element_at(F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, per_language / r["count"]))]), F.col("lang"))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000))
    taken = rows.filter(draw < share * 1_000_000)
    aside = F.pmod(F.xxhash64("text", "id"), F.lit(CALIBRATE)) == 0
    return taken.select("lang", aside.alias("aside"), "text").mapInArrow(
        _counted, "lang string, aside boolean, buckets array<int>, counts array<int>")


def _in_order(rows: pa.Table, languages: tuple[str, ...]) -> list[tuple]:
    """``language, aside, buckets, counts`` of each row, sorted by these; buckets and
    counts stay numbers of four bytes, which the driver holds once, and no Python objects."""
    def lists(name: str) -> list[np.ndarray]:
        column = rows.column(name).combine_chunks()
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1])

    number = {name: i for i, name in enumerate(languages)}
    data = [(number[y], a, b, c) for y, a, b, c in zip(
        rows.column("lang").to_pylist(), rows.column("aside").to_pylist(), lists("buckets"), lists("counts"))]
    # Numbers of a fixed width, the highest byte first: bytes sort as the numbers do.
    ordered = lambda numbers: numbers.astype(">i4").tobytes()
    return sorted(data, key=lambda row: (row[0], row[1], ordered(row[2]), ordered(row[3])))


def train(labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """The model of the labelled rows; None when none has a language and a letter."""
    rows = sampled(labelled, id, text, lang, per_language).toArrow()
    if not rows.num_rows:
        return None
    languages = tuple(sorted(rows.column("lang").unique().to_pylist()))
    data = _in_order(rows, languages)
    rng = np.random.default_rng(1)
    fit = [(y, b, c / c.sum()) for y, aside, b, c in data if not aside]
    held = [(y, b, c / c.sum()) for y, aside, b, c in data if aside] or fit
    fit = fit or held
    rarity = _rarity([row for row in data if not row[1]] or data)
    size = np.array([c.sum() for _, aside, _, c in data if aside] or [c.sum() for *_, c in data])
    embedding = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    output, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, done = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            y, bucket, share = fit[i]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ embedding[bucket]
            error = _softmax((mean @ output + bias)[None])[0]
            error[y] -= 1
            back = output @ error
            output -= rate * np.outer(mean, error)
            bias -= rate * error
            # A text has one gradient for its mean; each group gets its share of it.
            embedding[bucket] -= rate * len(bucket) ** 0.5 * np.outer(share, back)
    table = (embedding @ output).astype(np.float32)
    logits = np.stack([share @ table[bucket] + bias for _, bucket, share in held])
    truth = np.array([y for y, _, _ in held])
    lines = np.arange(len(held))
    loss = lambda s: -np.log(np.maximum(_softmax(logits * s)[lines, truth], 1e-12)).mean()
    # The mildest scale that the rows set aside cannot tell from the best one.
    losses = {s: loss(s) for s in (2.0 ** k for k in range(-3, 7))}
    scale = min(s for s, l in losses.items() if l <= min(losses.values()) + 2 / len(held))
    mean, square = (np.array([share @ rarity[bucket] ** k for _, bucket, share in held]) for k in (1, 2))
    good = _familiarity(mean, square, size)[logits.argmax(axis=1) == truth]
    # A few rows cannot show so small a share, so what lies near them passes as well.
    near = DEVIATIONS * (1 + 2 / max(1, len(good)) ** 0.5)
    least = min(float(np.quantile(good, FALSE_REJECTIONS)), good.mean() - near * good.std()) if len(good) else -np.inf
    return Model(languages, table, bias, scale, rarity, least)


def _predicted(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            languages, scores, rejected = [], [], []
            for texts in groups(values_of(batch, "text")):
                if model is None:
                    languages += [UNKNOWN] * len(texts)
                    scores += [0.0] * len(texts)
                    rejected += [True] * len(texts)
                    continue
                p, n, familiar = model.scores(texts)
                best = p.argmax(axis=1)
                languages += [model.languages[k] if m else UNKNOWN for k, m in zip(best, n)]
                scores += np.where(n > 0, p.max(axis=1), 0.0).tolist()
                rejected += ((n == 0) | (familiar < model.least)).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(languages, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())], names)
    return run


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``doc`` (the columns ``keep``, all by default), ``lang_pred, score, rejected``.

    A null text and one without letters are ``und`` with score 0, and rejected; so is
    every text without a model; so is a text of letter groups that are rare in all learned
    languages, whatever its score. Rows are predicted each for itself, from the text alone.
    The model has a fixed number of rows and at most ``LANGUAGES`` columns, so it is
    broadcast.
    """
    rows = docs.select(F.struct(*(keep or ["*"])).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc", "lang_pred", "score", "rejected"]
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, lang_pred string, score double, rejected boolean"
    return rows.mapInArrow(_predicted(shared, names), schema)
