"""Exact token ids of whole texts with a public tokenizer file, encoded unit by unit.

A byte-level tokenizer never merges across the border before a single space that stands next to a
character which is no white space. Texts are cut there, each distinct unit is encoded once per worker
by the `tokenizers` library, and the ids of a text are the joined ids of its units. Texts where a cut
would not be safe (runs of white space, strings of special tokens) are encoded whole.
"""

from __future__ import annotations

import re
import string
import struct
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa

from clipwarden.llm.common import text_rows, worker_state

END_ID = 0
#: Entries that each of a worker's two tables may hold before it is emptied; bounds its memory.
TABLE_ENTRIES = 350_000
#: The same for the one table of the encoder of blocks.
BLOCK_ENTRIES = 700_000

# White space of the two regular expression dialects.
WHITE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0            "
    "    　"
)
LATIN_END = "\u0250"
#: ASCII signs that form one pretoken behind letters; an apostrophe may begin a contraction.
SIGNS = string.punctuation.replace("'", "")
# Fixed value: how byte-level vocabularies split text before merging.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


def id_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class UnitTable(dict):
    """Unit -> bytes of its ids; a unit is what follows a single space.

    Letters alone are one pretoken, and so are the signs behind them: these units need no regular expression,
    and a word with signs is made of entries for the word and for the signs.
    """

    def __init__(self, encode_unit: Callable[[str], bytes], encode_piece: Callable[[str], bytes], entries: int) -> None:
        super().__init__()
        self.encode_unit, self.encode_piece, self.entries = encode_unit, encode_piece, entries
        self.signs: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.entries:
            self.clear()
        # letters beyond Latin may be of a newer Unicode version than the library's
        latin = unit.isascii() or max(unit) < LATIN_END
        if latin and unit.isalpha():
            found = self.encode_piece(" " + unit)
        else:
            word = unit.rstrip(SIGNS)
            if latin and word.isalpha():
                signs = unit[len(word) :]
                tail = self.signs.get(signs)
                if tail is None:
                    if len(self.signs) >= self.entries:
                        self.signs.clear()
                    tail = self.signs[signs] = self.encode_piece(signs)
                found = self[word] + tail
            else:
                found = self.encode_unit(" " + unit)
        self[unit] = found
        return found


#: Looked for one by one: a single character is found much faster than two.
BEFORE_SPACE = [(c, c + " ") for c in WHITE]


def cuttable(text: str) -> bool:
    """Whether every single space of `text` may be a cut: none has white space on both sides."""
    if any(c in text and pair in text for c, pair in BEFORE_SPACE):
        return re.search(rf"[{WHITE}] [{WHITE}]|[{WHITE}] \Z", text) is None
    return True


def unit_encoder(
    specials: list[str], encode_whole: Callable[[str], bytes], encode_unit: Callable[[str], bytes],
    encode_piece: Callable[[str], bytes],
) -> Callable[[str], bytes]:
    """Text -> little-endian unsigned 32-bit ids.

    The functions encode a whole text, a unit with its space, and one pretoken.
    """
    table = UnitTable(encode_unit, encode_piece, TABLE_ENTRIES)
    look_up = table.__getitem__

    def encode(text: str) -> bytes:
        if any(s in text for s in specials) or not cuttable(text):
            return encode_whole(text)
        units = text.split(" ")
        first = encode_unit(units[0]) if units[0] else b""
        return first + b"".join(map(look_up, units[1:]))

    return encode


BlockEncoder = Callable[[list[str]], list[bytes]]


def block_encoder(path: str) -> BlockEncoder:
    """Encoder of many texts at a time with the `tokenizers` file at `path`, one per worker.

    The units of a block that are not known yet are encoded first, words of letters by the library's model alone and
    others joined, where the bytes of the vocabulary's entries tell which ids belong to which unit. Texts that cannot
    be cut are encoded whole.
    """
    state = worker_state()
    if ("blocks", path) in state:
        return state["blocks", path]
    import json

    import numpy as np
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_padding()
    tok.no_truncation()
    spec = json.loads(tok.to_str())
    pre, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
    specials = [a["content"] for a in added]
    simple = (
        spec["model"]["type"] == "BPE"
        and not spec.get("normalizer")
        and pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space")
        and pre.get("use_regex", True)
        and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or " " in a["content"] for a in added)
    )

    def whole(text: str) -> bytes:
        return id_bytes(tok.encode(text, add_special_tokens=False).ids)

    # one character of a byte-level entry stands for one byte
    sizes = np.zeros(tok.get_vocab_size(), np.int64)
    for token, number in tok.get_vocab().items():
        sizes[number] = len(token)
    table: dict[str, bytes] = {}

    signs: dict[str, bytes] = {}

    symbols, tokenize = str.maketrans(dict(enumerate(byte_symbols()))), tok.model.tokenize

    def enter(units: list[str], ids: np.ndarray, ends: list[int]) -> None:
        data = ids.tobytes()
        table.update(zip(units, (data[i:j] for i, j in zip([0, *ends], ends))))

    def learn_words(words: list[str]) -> None:
        """Letters alone are one pretoken: the model takes them as they are."""
        mapped = " ".join(words).encode().decode("latin-1").translate(symbols)
        space = symbols[ord(" ")]
        ids: list[int] = []
        ends = []
        for word in mapped.split(space):
            ids += [t.id for t in tokenize(space + word)]
            ends.append(4 * len(ids))
        enter(words, np.array(ids, "<u4"), ends)

    def learn_others(units: list[str]) -> None:
        for at in range(0, len(units), 200):
            part = units[at : at + 200]
            joined = " " + " ".join(part)
            ids = np.array(tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            lengths = np.cumsum([len(u.encode()) + 1 for u in part])
            enter(part, ids, (4 * np.searchsorted(np.cumsum(sizes[ids]), lengths) + 4).tolist())

    def learn(units: set[str]) -> None:
        """Signs behind letters are a pretoken of their own: such a unit is the entry of its word and that of its signs."""
        words, others, signed = set(), [], []
        for unit in units:
            word = unit.rstrip(SIGNS)
            # letters beyond Latin may be of a newer Unicode version than the library's
            if word.isalpha() and (word.isascii() or max(word) < LATIN_END):
                if word not in table:
                    words.add(word)
                if len(word) < len(unit):
                    signed.append((unit, word))
            else:
                others.append(unit)
        if words:
            learn_words(list(words))
        learn_others(others)
        for unit, word in signed:
            tail = unit[len(word) :]
            found = signs.get(tail)
            if found is None:
                if len(signs) >= TABLE_ENTRIES:
                    signs.clear()
                found = signs[tail] = whole(tail)
            table[unit] = table[word] + found

    def encode(texts: list[str]) -> list[bytes]:
        if not simple:
            return list(map(whole, texts))
        if len(table) > BLOCK_ENTRIES:
            table.clear()
        cut = [None if any(s in t for s in specials) or not cuttable(t) else t.split(" ") for t in texts]
        fresh = set().union(*[u[1:] for u in cut if u]).difference(table)
        if fresh:
            learn(fresh)
        look_up = table.__getitem__
        out = []
        for text, units in zip(texts, cut):
            if units is None:
                out.append(whole(text))
            else:
                first = whole(units[0]) if units[0] else b""
                out.append(first + b"".join(map(look_up, units[1:])))
        return out

    state["blocks", path] = encode
    return encode


#: Characters of text that are encoded together; a longer text makes a longer block.
BLOCK_CHARS = 1 << 20


def encoded_rows(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[tuple[Any, bytes]]:
    """(doc_id, ids of the text and the end id); null texts are empty."""
    encode, end = block_encoder(path), id_bytes([END_ID])
    keys: list[Any] = []
    texts: list[str] = []
    held = 0
    for key, text in text_rows(batches):
        keys.append(key)
        texts.append(text)
        held += len(text)
        if held >= BLOCK_CHARS:
            for known, ids in zip(keys, encode(texts)):
                yield known, ids + end
            keys, texts, held = [], [], 0
    for known, ids in zip(keys, encode(texts)):
        yield known, ids + end
