"""Toxicity by a weighted finite-state grammar over clauses.

A word is a symbol: insult, doubtful, threat, target, negation, report, border or other. Small
transducers read the symbols of a clause and add a mark to an insult or a threat that is
negated, only reported, or aimed at somebody; composed they are one machine with one
table of transitions. Each marked match has a weight, so a negated insult counts less
than one thrown at the reader; a document's score is the logistic of its sums.

Insults are learned: words and word beginnings that toxic texts have far more often than
clean ones, chosen so that few of them cover the toxic texts; those that clean texts have
now and then are doubtful ones. The weights are learned too and stay close to the
grammar's own where the labels say nothing.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import values_of

SAMPLE = 50_000        # labelled rows of either class that are learned from, in expectation
BEGINNINGS = range(4, 10)
LEAST = 3              # toxic texts that a term must occur in
PRECISE, DOUBTFUL = 0.97, 0.85  # share of a term's rates that is the toxic one
MOST = 8               # matches of a kind that count
TARGET_REACH, NEGATION_REACH = 5, 3  # words
CUT = 0.3

# Function words of the grammar.
WORDS = {
    "target": "you your yours yourself they them their he she him her tu toi vous ton votre du dich dir ihr euch dein eure "
              "usted ustedes tú te vosotros",
    "negation": "not never no isn't don't pas jamais aucun nicht nie kein keine nunca jamás ningún",
    "report": "said says called wrote claimed reported quoted dit écrit appelé sagte nannte schrieb dijo llamó escribió",
    "threat": "kill murder hurt destroy tuer frapper détruire töten schlagen vernichten matar golpear destruir",
}
BORDERS = ".!?;:\n"
SYMBOLS = ("other", "border", "insult", "doubtful", "threat", "target", "negation", "report")
MARKS = ("aimed", "negated", "reported")
KINDS = [(s, *marks) for s in ("insult", "doubtful", "threat") for marks in product((0, 1), repeat=3)]
# The grammar's own weights: an insult, and what each mark adds.
_OWN = {"insult": 2.5, "doubtful": 1.5, "threat": 0.3}
_ADDED = (0.5, -1.0, -0.5)
PRIOR = np.array([_OWN[s] + sum(a * m for a, m in zip(_ADDED, marks)) for s, *marks in KINDS])

_token = re.compile(r"[^\W\d_]+(?:'t)?|[.!?;:\n]").findall


@dataclass(frozen=True)
class Transducer:
    """``steps[state, symbol] = (next state, mark)``; 0 is the first state."""

    states: int
    steps: dict[tuple[int, str], tuple[int, tuple[int, ...]]]

    def then(self, other: "Transducer") -> "Transducer":
        """Both machines read the same symbols; marks are put side by side."""
        number = lambda a, b: a * other.states + b
        steps = {}
        for (a, symbol), (a2, m) in self.steps.items():
            for b in range(other.states):
                b2, n = other.steps[b, symbol]
                steps[number(a, b), symbol] = (number(a2, b2), (*m, *n))
        return Transducer(self.states * other.states, steps)


def _reach(opener: str, reach: int) -> Transducer:
    """Marks what comes at most ``reach`` words after the opener, in the same clause."""
    steps = {}
    for state, symbol in product(range(reach + 1), SYMBOLS):
        after = 0 if symbol == "border" else reach if symbol == opener else max(0, state - 1)
        steps[state, symbol] = (after, (int(state > 0),))
    return Transducer(reach + 1, steps)


def _clause(opener: str) -> Transducer:
    """Marks what follows the opener anywhere in the same clause."""
    steps = {}
    for state, symbol in product((0, 1), SYMBOLS):
        steps[state, symbol] = (0 if symbol == "border" else 1 if symbol == opener else state, (state,))
    return Transducer(2, steps)


def grammar() -> Transducer:
    """Marks in the order of ``MARKS``."""
    return _reach("target", TARGET_REACH).then(_reach("negation", NEGATION_REACH)).then(_clause("report"))


@dataclass(frozen=True)
class Model:
    """``terms``: words, and beginnings that end in ``*``, each with its symbol; ``weights`` by ``KINDS``."""

    terms: tuple[tuple[str, str], ...]
    weights: np.ndarray = field(default_factory=lambda: PRIOR)
    bias: float = -3.0

    @cached_property
    def _symbols(self) -> dict[str, str]:
        table = {w: s for s, words in WORDS.items() for w in words.split()} | {b: "border" for b in BORDERS}
        return table | {t: s for t, s in self.terms if not t.endswith("*")}

    @cached_property
    def _beginnings(self) -> dict[str, str]:
        return {t[:-1]: s for t, s in self.terms if t.endswith("*")}

    @cached_property
    def _lengths(self) -> list[int]:
        return sorted({len(t) for t in self._beginnings})

    @cached_property
    def _machine(self) -> Transducer:
        return grammar()

    @cached_property
    def _any(self):
        """Finds whether a lower-case text holds any term at all."""
        import ahocorasick

        terms = ahocorasick.Automaton()
        for term in {*self._beginnings, *(t for t, s in self._symbols.items() if s in _OWN)}:
            terms.add_word(term, term)
        terms.make_automaton()
        return terms

    def counts(self, text: str) -> np.ndarray:
        """Matches of each kind. An insult is aimed also when its target follows it in the
        clause, so the clause is read from both ends."""
        found = np.zeros(len(KINDS))
        low = text.lower()
        if next(self._any.iter(low), None) is None:
            return found
        symbols = [self._symbol(w) for w in _token(low)]
        ahead, behind = self._read(symbols), self._read(symbols[::-1])[::-1]
        for symbol, marks, back in zip(symbols, ahead, behind):
            if symbol in _OWN:
                found[KINDS.index((symbol, int(marks[0] or back[0]), marks[1], marks[2]))] += 1
        return found

    def _symbol(self, word: str) -> str:
        return self._symbols.get(word) or next(
            (self._beginnings[word[:n]] for n in self._lengths if word[:n] in self._beginnings), "other")

    def _read(self, symbols: list[str]) -> list[tuple[int, ...]]:
        state, steps, marks = 0, self._machine.steps, []
        for symbol in symbols:
            state, mark = steps[state, symbol]
            marks.append(mark)
        return marks

    def score(self, counts: np.ndarray) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.bias + float(np.minimum(counts, MOST) @ self.weights)))))


def terms_of(text: str) -> set[str]:
    words = {w for w in _token(text.lower()) if w not in BORDERS}
    return words | {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) > k}


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = Counter(), Counter()
        for toxic, text in zip(*(values_of(batch, c) for c in ("toxic", "text"))):
            seen[toxic].update(terms_of(text))
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(
            pa.array([seen[k][t] for t in terms], pa.int64()) for k in (1, 0))], ["term", "toxic", "clean"])


def _terms_present(candidates: list[str]):
    number = {t: i for i, t in enumerate(candidates)}
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(number[t] for t in terms_of(text) if t in number) for text in values_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["terms"])
    return run


def choose_terms(candidates: list[str], texts: list[set[int]], least: int = LEAST) -> tuple[str, ...]:
    """Greedy cover: the term that covers most of the texts not yet covered, the longest of
    equals, until one covers fewer than ``least``; then every term with a fiftieth of all
    texts. A beginning whose texts nearly all have one and the same longer one is left out
    for that one, and so is a term that a chosen beginning implies."""
    total = Counter(t for terms in texts for t in terms)
    number = {t: i for i, t in enumerate(candidates)}
    longer: Counter = Counter()
    for t, n in total.items():
        stem = candidates[t].rstrip("*")
        for k in BEGINNINGS:
            shorter = number.get(stem[:k] + "*") if k < len(stem) else None
            if shorter is not None:
                longer[shorter] = max(longer[shorter], n)
    usable = {t for t, n in total.items() if longer[t] < 0.95 * n}
    # Counts only fall, so what lies in the heap is an upper bound until it is looked at.
    rank = {t: i for i, t in enumerate(sorted(usable, key=lambda t: (len(candidates[t]), candidates[t])))}
    holders: dict[int, list[int]] = defaultdict(list)
    for i, terms in enumerate(texts):
        for t in terms & usable:
            holders[t].append(i)
    hits, left, chosen = {t: len(at) for t, at in holders.items()}, [True] * len(texts), []
    heap = [(-n, -rank[t], t) for t, n in hits.items()]
    heapq.heapify(heap)
    while heap:
        bound, order, best = heapq.heappop(heap)
        if -bound != hits[best]:
            heapq.heappush(heap, (-hits[best], order, best))
            continue
        if hits[best] < least:
            break
        chosen.append(best)
        for i in holders[best]:
            if left[i]:
                left[i] = False
                for t in texts[i] & usable:
                    hits[t] -= 1
    often = [t for t in usable if total[t] >= max(8, len(texts) / 50)]
    kept: set[str] = set()
    for name in sorted({candidates[t] for t in (*chosen, *often)}, key=lambda t: (not t.endswith("*"), len(t), t)):
        stem = name.rstrip("*")
        if not any(stem[:k] + "*" in kept for k in range(1, len(stem) + 1)):
            kept.add(name)
    return tuple(sorted(kept))


def labelled_sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, sample: int) -> tuple[DataFrame, float]:
    """``toxic, text`` of different texts: about ``sample`` labelled rows of either class.

    A hash of the id decides. The labels that are taken are few by construction and are
    broadcast, so texts without one are not moved. Of several labels the highest holds.
    Also the number of clean rows for each one taken.
    """
    known = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("toxic")).filter("id is not null and toxic in (0, 1)")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, sample / sizes.get(1, sample))).otherwise(min(1.0, sample / sizes.get(0, sample)))
    taken = known.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share * 1_000_000)
    texts = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(F.broadcast(taken), "id").groupBy(F.md5("text").alias("copy")).agg(
        F.max("toxic").alias("toxic"), F.any_value("text").alias("text")).select("toxic", "text"), max(1.0, sizes.get(0, 0) / sample)


def train(docs: DataFrame, labels: DataFrame, store, id: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE) -> Model:
    """The model of the labelled rows of ``docs``. ``store`` writes a table that is read
    several times. Without a toxic text the grammar has no terms and its own weights."""
    taken, clean_weight = labelled_sample(docs, labels, id, text, label, sample)
    rows = store(taken)
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not sizes.get(1):
        return Model(())
    counted = (rows.mapInArrow(_term_counts, "term string, toxic bigint, clean bigint")
               .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    rate = F.col("toxic") / sizes[1]
    other = F.col("clean") / max(1, sizes.get(0, 0))
    share = rate / (rate + other)
    found = store(counted.select("term", "toxic", share.alias("share")).filter((F.col("toxic") >= LEAST) & (F.col("share") >= DOUBTFUL)))
    candidates = {r["term"]: r["share"] for r in _telling(found).collect()}
    present = rows.filter("toxic = 1").select("text").mapInArrow(_terms_present(list(candidates)), "terms array<int>")
    chosen = choose_terms(list(candidates), [set(r["terms"]) for r in present.collect()])
    terms = tuple((t, "insult" if candidates[t] >= PRECISE else "doubtful") for t in chosen)
    data = rows.mapInArrow(_features(Model(terms)), "toxic int, counts array<double>").groupBy("toxic", "counts").count().collect()
    return Model(terms, *_fit(data, clean_weight))


def _telling(terms: DataFrame) -> DataFrame:
    """Terms without the beginnings whose texts nearly all have one and the same longer one.

    What is left are at most the different words of the sampled toxic texts that occur in
    ``LEAST`` of them and in hardly a clean one, and the beginnings that join several.
    """
    stem = F.regexp_replace("term", r"\*$", "")
    shorter = F.explode(F.transform(
        F.filter(F.lit([*BEGINNINGS]), lambda k: k < F.length(stem)), lambda k: F.concat(F.substring(stem, F.lit(1), k), F.lit("*"))))
    longer = terms.select(shorter.alias("term"), "toxic").groupBy("term").agg(F.max("toxic").alias("longer"))
    return terms.join(longer, "term", "left").filter(F.coalesce("longer", F.lit(0)) < 0.95 * F.col("toxic")).select("term", "share")


def _features(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.minimum(model.counts(text), MOST).tolist() for text in values_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(counts, pa.list_(pa.float64()))], ["toxic", "counts"])
    return run


def _fit(data: list, clean_weight: float, pull: float = 1.0, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps; weights are pulled to the grammar's own. Clean
    rows count for those that were not sampled.

    A step is halved until the loss falls. The loss is convex, so this ends at its only
    minimum; should numbers fail it, the grammar's own weights stand.
    """
    x = np.column_stack((np.array([r["counts"] for r in data]), np.ones(len(data))))
    y, n = np.array([r["toxic"] for r in data]), np.array([r["count"] for r in data], float)
    n = np.where(y == 1, n, n * clean_weight)
    start = np.append(PRIOR, -3.0)

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(n @ (np.logaddexp(0, z) - y * z) + pull / 2 * ((w - start) ** 2).sum())

    w, now = start.copy(), loss(start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (n * (p - y)) + pull * (w - start)
        if np.abs(slope).max() < 1e-6 * max(1.0, n.sum()):
            return w[:-1], float(w[-1])
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-12 and not (then := loss(w - size * step)) <= now - 1e-4 * size * float(slope @ step):
            size /= 2
        if size <= 1e-12:
            break
        w, now = w - size * step, then
    return start[:-1], float(start[-1])


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(model.counts(text)) for text in values_of(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(scores, pa.float64())], ["doc", "score"])
    return run


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``doc`` (the columns ``keep``, all by default), ``score`` (0 to 1) and ``predicted``.

    A null text is an empty one; it has no match and the score of such texts. Rows are
    scored each for itself, from the whole text alone. The model's terms each cover ``LEAST``
    texts of the sample that no other covers, or many of it, so they are bounded by the sample
    and are broadcast.
    """
    rows = docs.select(F.struct(*(keep or ["*"])).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = rows.mapInArrow(_scored(shared), f"doc {rows.schema['doc'].dataType.simpleString()}, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
