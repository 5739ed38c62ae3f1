"""Numpy helpers that run inside tasks on one batch of rows at a time."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCORE_DIGITS = 6
TILE_CELLS = 4_000_000
PIECE_BYTES = 4 << 20       # text that is cut into words at once
TILE_ROWS = 1_024           # queries and rows of a tile of single-precision scores
WORD_GAP = r"[^\p{L}\p{N}]+"


class BestMatches:
    """The k best (score, id) of each query so far; equal scores go to the lower id."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.scores = np.full((n_queries, k), -np.inf)
        self.ids = np.full((n_queries, k), np.iinfo(np.int64).max)

    def add(self, scores: np.ndarray, ids: np.ndarray, queries: np.ndarray | None = None) -> None:
        """Scores of shape (queries, rows); ``-inf`` marks what is no match.

        ``queries`` are the positions of the queries scored, by default all of them.
        """
        if not scores.size:
            return
        if queries is None:
            queries = np.arange(len(self.scores))
        scores = np.round(scores, SCORE_DIGITS)
        floor = self.scores[queries, -1:]
        if scores.shape[1] > self.k:
            kth = np.partition(scores, -self.k, axis=1)[:, -self.k][:, None]
            floor = np.maximum(floor, kth)
        row, col = np.nonzero((scores >= floor) & (scores > -np.inf))
        self.merge(queries[row], scores[row, col], ids[col])

    def merge(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Rounded scores of single pairs, each with the position of its query."""
        if not queries.size:
            return
        held = np.unique(queries)
        all_rows = np.concatenate([np.repeat(held, self.k), queries])
        all_scores = np.concatenate([self.scores[held].ravel(), scores])
        all_ids = np.concatenate([self.ids[held].ravel(), ids])
        order = np.lexsort((all_ids, -all_scores, all_rows))
        first = np.searchsorted(all_rows[order], held)
        take = order[first[:, None] + np.arange(self.k)]
        self.scores[held] = all_scores[take]
        self.ids[held] = all_ids[take]

    def rows(self, query_ids: np.ndarray) -> pa.RecordBatch:
        query, slot = np.nonzero(self.scores > -np.inf)
        return pa.RecordBatch.from_arrays([
            pa.array(query_ids[query], pa.int64()),
            pa.array(self.ids[query, slot], pa.int64()),
            pa.array(self.scores[query, slot], pa.float64()),
        ], names=["query_id", "id", "score"])


def unit_rows(ids: pa.Array, vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of the rows that have a usable vector.

    A null or zero vector, one with a null or non-finite element, or one of another
    dimension has no cosine with anything.
    """
    lengths = pc.fill_null(pc.list_value_length(vectors), -1)
    fits = pc.and_(pc.equal(lengths, dim), pc.is_valid(ids))
    ids, vectors = ids.filter(fits), vectors.filter(fits)
    flat = vectors.flatten()
    matrix = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), dim)
    norm = np.sqrt((matrix * matrix).sum(axis=1))
    good = np.isfinite(norm) & (norm > 0)
    return ids.to_numpy(zero_copy_only=False)[good], matrix[good] / norm[good][:, None]


def fewest_copies(ids: np.ndarray, matrix: np.ndarray, k: int) -> np.ndarray:
    """Positions of the rows that may be among the ``k`` best of any query: of equal vectors, which
    have equal scores, those with the ``k + 1`` lowest ids (one may be the query's own), and at most
    ``k`` rows of one id."""
    keys = np.ascontiguousarray(matrix).view(np.dtype((np.void, matrix.itemsize * matrix.shape[1]))).ravel()
    _, group = np.unique(keys, return_inverse=True)
    if not len(group) or group.max() + 1 == len(group):
        return np.arange(len(ids))
    order = np.lexsort((ids, group))
    g, i = group[order], ids[order]
    new_group = np.append(True, g[1:] != g[:-1])
    new_id = new_group | np.append(True, i[1:] != i[:-1])
    number = np.cumsum(new_id)
    at_group, at_id = np.flatnonzero(new_group), np.flatnonzero(new_id)
    of_group = number - number[at_group][np.cumsum(new_group) - 1]          # distinct ids before it
    of_id = np.arange(len(g)) - at_id[number - 1]                           # rows of its id before it
    return np.sort(order[(of_group <= k) & (of_id < k)])


def add_cosines(best: BestMatches, query_ids: np.ndarray, queries: np.ndarray,
                ids: np.ndarray, matrix: np.ndarray, threshold: float | None,
                skip_same_id: bool, chosen: np.ndarray | None = None, floors: np.ndarray | None = None) -> None:
    """Score the rows against the chosen queries, a bounded tile at a time; rows and queries are
    unit vectors. ``floors`` are scores that a query's matches are known to reach.

    A tile is scored in single precision first, whose error has a bound. What may reach a query's
    k-th best score by it, a few pairs, is scored in double precision.
    """
    if not len(ids) or not len(queries):
        return
    kept = fewest_copies(ids, matrix, best.k)
    if len(kept) < len(ids):
        ids, matrix = ids[kept], matrix[kept]
    least = -np.inf if threshold is None else threshold
    error = (matrix.shape[1] + 8) * 2.0 ** -23
    digit = 10.0 ** -SCORE_DIGITS
    places = np.arange(len(queries)) if chosen is None else chosen
    rows = matrix.astype(np.float32)
    by_id = np.argsort(ids, kind="stable") if skip_same_id else None
    for start in range(0, len(places), TILE_ROWS):
        at = places[start:start + TILE_ROWS]
        asked = queries[at]
        single = asked.astype(np.float32)
        known = np.full(len(at), least) if floors is None else np.maximum(floors[at], least)
        own, own_rows = _own_rows(query_ids[at], ids, by_id) if skip_same_id else (None, None)
        for lo in range(0, len(ids), TILE_ROWS):
            part = rows[lo:lo + TILE_ROWS]
            near = single @ part.T
            if skip_same_id:
                here = (own_rows >= lo) & (own_rows < lo + len(part))
                near[own[here], own_rows[here] - lo] = -np.inf
            low = np.maximum(best.scores[at, -1], known) - error - digit
            touched = np.flatnonzero(near.max(axis=1) >= low)
            if not len(touched):
                continue
            near, low = near if len(touched) == len(at) else near[touched], low[touched]
            if near.shape[1] > best.k:
                many = np.flatnonzero((near >= low[:, None]).sum(axis=1) > 2 * best.k)
                kth = np.partition(near[many], -best.k, axis=1)[:, -best.k]
                low[many] = np.maximum(low[many], kth.astype(np.float64) - 2 * error - digit)
            row, col = np.nonzero((near >= low[:, None]) & (near > -np.inf))
            for a in range(0, len(row), TILE_CELLS // matrix.shape[1] or 1):
                r, c = row[a:a + (TILE_CELLS // matrix.shape[1] or 1)], col[a:a + (TILE_CELLS // matrix.shape[1] or 1)] + lo
                scores = np.round(np.einsum("ij,ij->i", asked[touched[r]], matrix[c]), SCORE_DIGITS)
                use = scores >= np.maximum(least, best.scores[at[touched[r]], -1])
                best.merge(at[touched[r[use]]], scores[use], ids[c[use]])


def _own_rows(query_ids: np.ndarray, ids: np.ndarray, by_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a row with the same id, as positions; ``by_id`` sorts the rows."""
    ordered = ids[by_id]
    first, after = np.searchsorted(ordered, query_ids), np.searchsorted(ordered, query_ids, side="right")
    n = after - first
    query = np.repeat(np.arange(len(query_ids)), n)
    return query, by_id[np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]


def pieces(texts: pa.Array, rows: int | None = None) -> list[tuple[int, int]]:
    """Start and number of rows of slices with about ``PIECE_BYTES`` of text, and at most ``rows`` rows."""
    out, lo = [], 0
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    while lo < len(texts):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PIECE_BYTES, side="right"))
        hi = min(max(hi, lo + 1), len(texts), lo + (rows or len(texts)))
        out.append((lo, hi - lo))
        lo = hi
    return out


def word_lists(texts: pa.Array) -> pa.Array:
    """Lower-case runs of letters and digits of each text; may hold empty strings."""
    return pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), WORD_GAP)


def word_codes(lists: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """List number and position in ``known`` of each known word, and the list lengths."""
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    code = pc.fill_null(pc.index_in(flat, known), -1).to_numpy(zero_copy_only=False)
    found = real & (code >= 0)
    return row[found], code[found].astype(np.int64), np.bincount(row[real], minlength=len(lists))


class HashedWords:
    """Lexical feature hashing: no model, no meaning beyond shared words.

    Bucket and sign of a word come from its md5, so that any engine can repeat them.
    """

    def __init__(self, dim: int = 64):
        self.dim = dim

    def __call__(self, texts: pa.Array) -> np.ndarray:
        lists = word_lists(texts)
        n = len(lists)
        row = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        coded = lists.flatten().dictionary_encode()
        vocabulary = coded.dictionary.to_pylist()
        digests = [hashlib.md5(w.encode()).hexdigest() for w in vocabulary]
        bucket = np.array([int(d[:7], 16) % self.dim for d in digests], dtype=np.int64)
        sign = np.array([1.0 if int(d[7], 16) % 2 == 0 else -1.0 for d in digests])
        sign[[w == "" for w in vocabulary]] = 0.0
        code = coded.indices.to_numpy(zero_copy_only=False)
        if not len(code):
            return np.zeros((n, self.dim))
        sums = np.bincount(row * self.dim + bucket[code], weights=sign[code],
                           minlength=n * self.dim).reshape(n, self.dim)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        return np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)
