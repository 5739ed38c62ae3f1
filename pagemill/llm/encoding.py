"""Token ids of a tokenizer file, as the tokenizers library gives them.

The merges of a byte-level file are handed to tiktoken, which applies them several times
faster. Merges and ids come from the file alone. Texts of common characters, on whose
class, case and composition the engines agree, take that way; a text with any other
character, or with what may be a special token, goes to the tokenizers library whole.
Tests compare both ways.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ž"
_SIGNS = "!-/:-@\\[-`{-~¡-©«¬®-±´¶-¸»¿×÷–—‘-„…"
_UNCOMMON = re.compile(f"[^{_LETTERS}{_SIGNS}0-9 \\t\\n\\r]").search
# How the two public word patterns are written, and the same for the
# common characters.
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_OTHER = f"[^\\s0-9{_LETTERS}]"
_BYTE_LEVEL = f"{_SHORT}| ?[{_LETTERS}]+| ?[0-9]+| ?{_OTHER}+|\\s+(?!\\S)|\\s+"
_SPLIT_WRITTEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLIT = f"{_SHORT}|[{_LETTERS}]+|[0-9]|{_OTHER}+"
_END = "\x01"  # stands for the end of a word; no common text has it


# Fixed rule of public byte-level vocabularies.
def _byte_of() -> dict[str, int]:
    """The byte for which each character of a byte-level vocabulary stands: printable
    Latin-1 characters for themselves, then the other bytes in order from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """``text_ids(text)``: ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            told = json.load(f)
        kind, steps = told["pre_tokenizer"]["type"], told["pre_tokenizer"].get("pretokenizers", [])
        self.quick = self.words = None
        self.lower = False
        suffix = told["model"].get("end_of_word_suffix") or ""
        if kind == "ByteLevel" and not told["normalizer"] and not told["pre_tokenizer"]["add_prefix_space"] and not suffix:
            self._merge(told["model"], suffix, _BYTE_LEVEL)
        elif [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"].get("Regex") == _SPLIT_WRITTEN and suffix:
            self._merge(told["model"], suffix, f"[^{_END}]+{_END}")
            self.words = re.compile(_SPLIT).findall
            self.lower = any(n["type"] == "Lowercase" for n in told["normalizer"]["normalizers"])

    def _merge(self, model: dict, suffix: str, pattern: str) -> None:
        import tiktoken

        byte = _byte_of()
        def spelled(piece: str) -> bytes:
            ends = suffix and piece.endswith(suffix)
            return bytes(byte[c] for c in (piece[:-len(suffix)] if ends else piece)) + (_END.encode() if ends else b"")
        order = [bytes([b]) for b in range(256)]
        if suffix:  # the last byte of a word and its end are joined before anything else
            order += [bytes([b]) + _END.encode() for b in range(256)]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        order += [spelled(a + b) for a, b in pairs]
        ranks = {piece: rank for rank, piece in enumerate(order)}
        self.table = np.zeros(len(order), "<u4")
        for piece, number in model["vocab"].items():
            try:
                rank = ranks.get(spelled(piece))
            except KeyError:  # a special token is no byte-level piece
                continue
            if rank is not None:
                self.table[rank] = number
        self.quick = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def text_ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self.quick is None or "<|" in text or _UNCOMMON(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.words:
            words = self.words(text.lower() if self.lower else text)
            text = _END.join([*words, ""])
        return self.table[self.quick.encode_to_numpy(text)].tobytes()


@functools.cache
def encoder(file: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(file)


def values_of(batch: pa.RecordBatch, name: str) -> Iterable:
    """The values of a column one at a time, so that texts are not held twice."""
    return (value.as_py() for value in batch.column(name))
