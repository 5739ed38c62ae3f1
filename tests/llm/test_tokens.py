"""Token counts, token files and packing against the libraries."""

import random
import zlib
from collections import Counter as Tally

import numpy as np
import pytest
from tokenizers import Tokenizer

from pagemill.llm.common import tokenizer_file
from pagemill.llm.encoding import encoder
from pagemill.llm.packing import packed, plan
from pagemill.llm.token_counts import MARK, ChunkMap, compile_model, token_counts
from pagemill.llm.token_files import count_token, find_token, read_documents, write_token_files
from pagemill.llm.wavelet import WaveletMatrix, pack
from pagemill.session import new_dir

PIECES, BYTES, WORDS = (tokenizer_file(n) for n in ("piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", " ", "  a  b", "a\n\nb", "\ta", "<s>x</s>", "a▁b", " x", "ﬁ x²", "x ​ y", "\r\n", "日本語 テスト", "▁▁ x", "a\x00b",
       "🤦🏼‍♂️ ok\n\n\n", "aaaa" * 500, "<|endoftext|>x", "don't we'll 'S I'M x's", "İstanbul Σς ſ K", "¿Qué? «x» – “y” l’été…  z   ",
       "é x", "a  \n  b\t\t c ", "12345 6.7%", "!!!'s 's'ss", "Ŀ ŉ ĸ"]


def _texts():
    rng = random.Random(2)
    return ODD + ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéèöñ.,-'ETAOIN      0123\n", k=300)) for _ in range(300)]


@pytest.mark.parametrize("file", [BYTES, WORDS])
def test_encoder_equals_library(file):
    library = Tokenizer.from_file(file)
    for text in _texts():
        assert np.frombuffer(encoder(file).text_ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_counts_compose_in_any_grouping():
    counter, rng = compile_model(PIECES), random.Random(0)
    for text in _texts():
        marked = MARK + text.replace(" ", MARK) if text else ""
        cuts = sorted(rng.randrange(len(marked) + 1) for _ in range(rng.randrange(9)))
        maps = [counter.chunk(marked[a:b]) for a, b in zip([0, *cuts], [*cuts, len(marked)])]
        while len(maps) > 1:
            i = rng.randrange(len(maps) - 1)
            maps[i:i + 2] = [maps[i].then(maps[i + 1], counter)]
        assert maps[0].total(counter) == len(counter.model.encode(text)), text


def test_table_of_units_is_bounded():
    from pagemill.llm.token_counts import Counter
    counter = Counter(PIECES, known=50)
    text = MARK + MARK.join(f"word{i}" for i in range(500))
    assert counter.chunk(text).total(counter) == len(counter.model.encode(text.replace(MARK, " ")[1:]))
    assert len(counter.table) <= 51 and ChunkMap("", 0, "").total(counter) == 0


@pytest.mark.parametrize("chunk", [1 << 18, 1000])
def test_token_counts(docs, empty, plain, chunk):
    model = compile_model(PIECES).model
    got = sorted((str(r["id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(docs, PIECES, chunk=chunk).collect())
    tokens = {t: len(model.encode(t or "")) for _, t, _ in plain}
    assert got == sorted((str(i), len((t or "").encode()), tokens[t], tokens[t] > 4096) for i, t, _ in plain)
    assert token_counts(empty, PIECES).collect() == []


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 512, 513, 5000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 3000).astype(np.uint32)
    m = WaveletMatrix(pack(ids))
    assert len(m) == n and (m.unpack() == ids).all() and (m.access(np.arange(n)) == ids).all()
    at = rng.integers(0, n + 1, 50)
    for token in {*ids[:10].tolist(), 99_999, 7}:
        assert m.rank(token, at).tolist() == [(ids[:i] == token).sum() for i in at]
        assert m.find(token).tolist() == np.flatnonzero(ids == token).tolist()
        assert m.count(token) == (ids == token).sum()
        with pytest.raises(IndexError):
            m.select(token, [m.count(token)])


def test_large_ids():
    ids = np.array([1 << 31, 5, 1 << 31, 4_000_000_000], np.uint32)
    assert (WaveletMatrix(pack(ids)).unpack() == ids).all()


def _ids(file, text):
    return [*Tokenizer.from_file(file).encode(text or "", add_special_tokens=False).ids, 2]


def test_token_files(spark, docs, empty, plain):
    path = new_dir(spark, "files")
    write_token_files(docs, path, WORDS, limit=500)
    rows = read_documents(spark, path).orderBy("start").collect()
    ids = [r["id"] for r in rows]
    assert ids == sorted([i for i, *_ in plain], key=lambda i: (i is None, i or 0))
    library = Tokenizer.from_file(WORDS)
    encoded = {t: [*library.encode(t or "", add_special_tokens=False).ids, 2] for _, t, _ in plain}
    want = Tally((i, len(encoded[t]), zlib.crc32(np.array(encoded[t], "<u4").tobytes())) for i, t, _ in plain)
    assert Tally((r["id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows]).tolist()[:-1]]
    total = sum(encoded[t].count(2) for _, t, _ in plain)
    assert count_token(spark, path, 2).agg({"n": "sum"}).first()[0] == total
    ends = {r["start"] + r["n_tokens"] - 1 for r in rows}
    assert ends <= {r["position"] for r in find_token(spark, path, 2).collect()}
    nothing = new_dir(spark, "files")
    write_token_files(empty, nothing, WORDS)
    assert read_documents(spark, nothing).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_packs_each_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(1025, np.int64)
    np.add.at(counts, rng.integers(1, 1025, (5, 300, 20_000, 3)[seed]), 1)
    if seed == 2:
        counts[700] += 8_000  # copies of one text
        counts[1:40] += 500
    filled, given = Tally(), Tally()
    for length, first, last, shift, offset in plan(counts):
        for rank in range(first, last):
            assert (length, rank) not in given
            given[length, rank] += 1
            filled[rank + shift] += length
            assert offset + length <= 1024
    assert len(given) == counts.sum() and all(r < counts[n] for n, r in given)
    assert max(filled.values()) <= 1024
    # Two pieces of more than half a sequence never share one.
    least = max(-(-int((counts * np.arange(1025)).sum()) // 1024), int(counts[513:].sum()))
    if seed == 2:
        assert len(filled) <= 1.01 * least + 1


def test_plan_of_many_copies_is_short():
    counts = np.zeros(1025, np.int64)
    counts[[300, 424, 700, 1000, 24]] = 10 ** 9
    assert len(plan(counts)) < 50


def test_packed(docs, empty, plain):
    rows = packed(docs, BYTES).collect()
    library = Tokenizer.from_file(BYTES)
    encoded = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, _ in plain]
    want = Tally()
    for i, ids in encoded:
        at = 0
        for piece in range(-(-len(ids) // 1024)):
            to = len(ids) - 1024 * (-(-len(ids) // 1024) - 1 - piece)
            want[i, piece, at, to - at, zlib.crc32(np.array(ids[at:to], "<u4").tobytes())] += 1
            at = to
    assert Tally((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert packed(empty, BYTES).collect() == []
