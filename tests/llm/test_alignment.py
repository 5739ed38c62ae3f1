"""Alignment against a loop over byte positions, with the libraries as they are."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pagemill.llm.alignment import _packed, _unpacked, align, alignments, groups_of, jumped, sections, tokenizer_pair
from pagemill.llm.common import tokenizer_file
from pagemill.llm.encoding import _byte_of
from tests.llm.test_tokens import ODD, _texts

FILES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def brute(libraries, text):
    """Groups and links of one text: ``[(a ids, b ids)]``, ``[(a, b)]``."""
    if not text:
        return [], []
    first, second = libraries
    a = first.encode(" " + text, add_special_tokens=False).ids
    b = second.encode(text)
    shown = _byte_of()
    spell_b = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    bytes_a = [bytes(shown[c] for c in first.id_to_token(i)) for i in a]
    bytes_b = [spell_b(i) for i in b]
    told = (" " + text).encode()
    if b"".join(bytes_a) != told or b"".join(bytes_b) != told:
        return [], []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    groups, i, j = [], 0, 0
    at_a, at_b = ({end: k for k, end in enumerate(ends)} for ends in (ends_a, ends_b))
    for end in sorted(set(ends_a) & set(ends_b)):
        i2, j2 = at_a[end] + 1, at_b[end] + 1
        groups.append((a[i:i2], b[j:j2]))
        i, j = i2, j2
    links, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        links.append((a[i], b[j]))
        x, y = ends_a[i], ends_b[j]
        i, j = i + (x <= y), j + (y <= x)
    return groups, links


_known = []  # of the fixture, once


def table(libraries, rows):
    found = [(id, *brute(libraries, text)) for id, text in rows]
    count = Counter(pair for _, _, links in found for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = Counter()
    for id, groups, links in found:
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out[id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            hashlib.sha256(told.encode()).hexdigest() if groups else "", sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links)] += 1
    return out, {(a, b, n, n == most[a]) for (a, b), n in count.items()}


@pytest.mark.parametrize("links", [2_000_000, 3_000])
def test_alignments(docs, empty, plain, libraries, links):
    rows, pairs = alignments(docs, *FILES, links=links)
    if not _known:
        _known.extend(table(libraries, [(i, t) for i, t, _ in plain]))
    assert Counter(tuple(r) for r in rows.collect()) == _known[0]
    assert {tuple(r) for r in pairs.collect()} == _known[1]
    rows, pairs = alignments(empty, *FILES)
    assert rows.collect() == [] and pairs.collect() == []


def test_odd_texts_and_sections(spark, libraries, monkeypatch):
    from pagemill.llm import alignment
    pair = tokenizer_pair(*FILES)
    for size in (1 << 16, 40):
        monkeypatch.setattr(alignment.sections, "__defaults__", (size,))
        for text in [*_texts(), "x " * 300, "a  b c\t d \n e" * 30]:
            groups, links = brute(libraries, text)
            f = align(pair, [text])
            got = [(f.ids[0][f.group[0] == k].tolist(), f.ids[1][f.group[1] == k].tolist()) for k in range(int(f.groups_upto[0]))]
            assert got == groups, text
            assert list(zip(f.ids[0][f.links[0]].tolist(), f.ids[1][f.links[1]].tolist())) == links, text


def test_sections_give_the_text_back():
    text = "ab  cd ef\n gh i" * 50
    made = list(sections(text, 20))
    assert len(made) > 10 and " ".join(made) == text


def test_pointers_meet_at_the_last_token_of_a_group():
    # a: 2 4 6 9, b: 3 5 6 7 9 -> groups end at 6 and 9, in a chain of six tokens and of three
    assert jumped(np.array([2, 4, 6, 9]), np.array([3, 5, 6, 7, 9])).tolist() == [6, 6, 6, 8, 6, 6, 6, 8, 8]
    n = 1 << 14  # one group of tokens that overlap all along
    ends = np.arange(1, n + 1) * 2
    assert set(jumped(np.append(ends, 2 * n + 1), np.append(ends - 1, [2 * n + 1])).tolist()) == {2 * n + 1}


def test_groups_of(spark, libraries):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id int, text string")
    for r in groups_of(rows, *FILES, keep=["doc_id"]).collect():
        assert [(g["a"], g["b"]) for g in r["groups"]] == brute(libraries, ODD[r["doc"]["doc_id"]])[0]
        ends = [g["end"] for g in r["groups"]]
        assert [g["start"] for g in r["groups"]] == [0, *ends][:len(ends)]
        assert not ends or ends[-1] == len((" " + ODD[r["doc"]["doc_id"]]).encode())


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_packed_numbers(n):
    values = np.random.default_rng(n).integers(0, 1 << 20, n)
    assert (_unpacked(_packed(values), n) == values).all()
