"""Byte-pair encoding by dynamic programming over prefixes, and decoding, exact to the token.

For every prefix of a pretoken there is one token that ends its encoding. An automaton over the
vocabulary gives the tokens that are suffixes of a prefix; a token t is the last one exactly if the
prefix before it is empty or ends in a token that is compatible with t, that is, encoding the two
tokens' bytes gives these two tokens back. The table of last tokens is followed back from the end.

Compatibility needs no encoding: along the right edge of the left token's merge tree and the left edge of
the right token's, the pieces that touch at some time are visited, and the pair is incompatible if their
merge would have come before the merge that consumes either of them.

Defined results: a null text is an empty one (no ids, empty decoded text); repeated rows give repeated
results; an empty table gives an empty result. Columns besides id and text are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from clipwarden.llm.common import id_and_text, text_rows, worker_state
from clipwarden.llm.tokens import PRETOKENS, TABLE_ENTRIES, byte_symbols, id_bytes, unit_encoder

NEVER = 1 << 40
BATCH_BYTES = 8 << 20


class Vocabulary:
    """Merge ranks, merge trees and bytes of a byte-level tokenizer file."""

    def __init__(self, spec: dict[str, Any]) -> None:
        model = spec["model"]
        back = {c: b for b, c in enumerate(byte_symbols())}
        vocab: dict[str, int] = model["vocab"]
        self.specials = {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for r, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, token = (vocab[left], vocab[right]), vocab[left + right]
            self.merged[pair] = r
            if token not in self.rank:
                self.rank[token], self.parts[token] = r, pair
        self.bytes: dict[int, bytes] = {}
        for text, token in vocab.items():
            if text in self.specials:
                continue
            self.bytes[token] = bytes(back[c] for c in text)
            if len(self.bytes[token]) == 1:
                self.rank[token] = -1
        self.decoded = self.bytes | {i: s.encode() for s, i in self.specials.items()}
        self._known: dict[int, bool] = {}
        # a token whose own bytes encode to something else never occurs in an encoding
        whole: dict[int, bool] = {}
        for token in sorted(self.rank, key=self.rank.__getitem__):
            parts = self.parts.get(token)
            whole[token] = parts is None or (whole[parts[0]] and whole[parts[1]] and self._touch(*parts, self.rank[token]))
        self.tokens = {t: self.bytes[t] for t, ok in whole.items() if ok}

    def _touch(self, left: int, right: int, until: int = NEVER) -> bool:
        """Whether no merge of rank below `until` crosses the border between two adjacent tokens."""
        left_until, right_until = until, until
        rank, parts, merged = self.rank, self.parts, self.merged
        while True:
            r = merged.get((left, right))
            if r is not None and r < left_until and r <= right_until and r < until:
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:  # the piece that was made later gives way to its parts
                left_until, left = a, parts[left][1]
            else:
                right_until, right = b, parts[right][0]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self._known.get(key)
        if found is None:
            if len(self._known) >= TABLE_ENTRIES:
                self._known.clear()
            found = self._known[key] = self._touch(left, right)
        return found


def prefix_encoder(path: str) -> tuple[Callable[[str], bytes], Vocabulary]:
    """Text -> little-endian 32-bit ids by the table of last tokens; one per worker."""
    state = worker_state()
    if ("prefixes", path) in state:
        return state["prefixes", path]
    import ahocorasick
    import regex

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer"):
        raise ValueError("a byte-level BPE file without normalizer is needed")
    words = Vocabulary(spec)
    automaton = ahocorasick.Automaton()
    for token, data in words.tokens.items():
        automaton.add_word(data.decode("latin-1"), (token, len(data)))
    automaton.make_automaton()
    matches, compatible, known_pairs = automaton.iter, words.compatible, words._known
    split = regex.compile(PRETOKENS).findall
    by_name = sorted(words.specials, key=len, reverse=True)
    cut = regex.compile("(" + "|".join(map(regex.escape, by_name)) + ")").split if by_name else lambda t: [t]
    known: dict[str, bytes] = {}

    def encode_piece(piece: str) -> bytes:
        data = piece.encode().decode("latin-1")
        last = [-1] * (len(data) + 1)  # the last token of each prefix
        size = [0] * (len(data) + 1)
        for end, (token, length) in matches(data):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                fits = known_pairs.get(before << 32 | token)
                if fits is None:
                    fits = compatible(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        ids, at = [], len(data)
        while at:
            if last[at] < 0:
                raise ValueError(f"the vocabulary cannot encode {piece!r}")
            ids.append(last[at])
            at -= size[at]
        return id_bytes(ids[::-1])

    def unit(text: str) -> bytes:
        out = []
        for piece in split(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= TABLE_ENTRIES:
                    known.clear()
                ids = known[piece] = encode_piece(piece)
            out.append(ids)
        return b"".join(out)

    def whole(text: str) -> bytes:
        out = []
        for part in cut(text):
            if part in words.specials:
                out.append(np.array([words.specials[part]], "<u4").tobytes())
            elif part:
                out.append(unit(part))
        return b"".join(out)

    state["prefixes", path] = unit_encoder(list(words.specials), whole, unit, encode_piece), words
    return state["prefixes", path]


def encode_decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) and the text decoded from these ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, words = prefix_encoder(tokenizer)
        piece = words.decoded.__getitem__
        out: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            cols = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.binary(), pa.string()))]
            return pa.RecordBatch.from_arrays(cols, ["doc_id", "ids", "decoded"])

        for key, text in text_rows(batches):
            ids = encode(text)
            decoded = b"".join(map(piece, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
            out.append((key, ids, decoded))
            held += len(ids)
            if held >= BATCH_BYTES:
                yield batch()
                out, held = [], 0
        if out:
            yield batch()

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id bigint, ids binary, decoded string")
