"""Token counts by batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigloom.llm.chunks import hashes, slices
from contigloom.llm.token_files import load_model
from contigloom.runtime import ship, tidy

#: No pre-token of a byte-level model runs from a non-space character on to white space, nor from a letter or digit on to these marks.
_BOUNDARY = re.compile("(?<=\\S)[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]|(?<=[^\\W_])[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f]")
_loaded: dict[str, object] = {}


def load_encoder(path: str):
    """Texts -> list of lengths, for a .json (tokenizers) or .model (sentencepiece) file."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            model = load_model(path)
            _loaded[path] = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
    return _loaded[path]


class PieceCounter:
    """Lengths of texts by way of a table of their pieces, of a fixed size, for byte-level models.

    A piece ends before every plain space that follows another character than white space: there a byte-level model's pre-tokens end too, so the tokens of
    a text are those of its pieces. A piece's 128-bit hash names its only slot, which a newer piece takes over; pieces of over
    255 tokens are not kept. New pieces go to the library many at a time, as one text with an added token between them.
    """

    STEP = 1 << 20

    def __init__(self, path: str, separator: str, slots: int = 1 << 20):
        self.model, self.separator, self.path = load_model(path), separator, path
        self.between = self.model.token_to_id(separator)
        self.first, self.second, self.size = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64), np.zeros(slots, np.uint8)

    def _learn(self, new: list[bytes], piece_chars: int) -> np.ndarray:
        texts = [w.decode("utf-8", "replace") for w in new]
        out = np.zeros(len(texts), np.int64)
        plain = [i for i, w in enumerate(texts) if len(w) <= piece_chars and self.separator not in w]
        for at in range(0, len(plain), 8192):
            some = plain[at : at + 8192]
            ids = np.array(self.model.encode_batch_fast([self.separator.join(texts[i] for i in some)], add_special_tokens=False)[0].ids, np.int64)
            out[some] = np.diff(np.concatenate([[-1], np.flatnonzero(ids == self.between), [len(ids)]])) - 1
        if len(plain) < len(texts):
            rest = sorted(set(range(len(texts))).difference(plain))
            out[rest] = _lengths([texts[i] for i in rest], load_encoder(self.path), self.STEP, piece_chars, True)
        return out

    def lengths(self, texts: list[bytes], piece_chars: int = 1 << 16) -> np.ndarray:
        out, start, held = [np.zeros(0, np.int64)], 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= self.STEP or i == len(texts) - 1:
                out.append(self._count(texts[start : i + 1], piece_chars))
                start, held = i + 1, 0
        return np.concatenate(out)

    def _count(self, texts: list[bytes], piece_chars: int) -> np.ndarray:
        raw = b"".join(texts)
        begins = np.cumsum([0, *map(len, texts)])
        start = piece_starts(np.frombuffer(raw, np.uint8), begins)
        end = np.append(start[1:], len(raw)) if len(start) else start
        a, b = hashes(raw, start, end, 0), hashes(raw, start, end, 1)
        slot = (a % np.uint64(len(self.size))).astype(np.int64)
        count = self.size[slot].astype(np.int64)
        miss = np.flatnonzero((self.first[slot] != a) | (self.second[slot] != b))
        if len(miss):
            _, at, back = np.unique(a[miss], return_index=True, return_inverse=True)
            if (b[miss] != b[miss[at]][back]).any():  # two pieces of one first hash: take every place by itself
                at = back = np.arange(len(miss))
            one = miss[at]
            size = self._learn([raw[s:e] for s, e in zip(start[one].tolist(), end[one].tolist())], piece_chars)
            count[miss] = size[back]
            short = np.flatnonzero(size < 256)
            where, own = np.unique(slot[one[short]], return_index=True)
            own = short[own]
            self.first[where], self.second[where], self.size[where] = a[one[own]], b[one[own]], size[own]
        sums = np.concatenate([[0], np.cumsum(count)])
        return np.diff(sums[np.searchsorted(start, begins)])


def piece_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Places where texts begin or a plain space follows another character than white space (of any width)."""
    cut = np.zeros(len(data) + 1, np.bool_)
    cut[begins] = True
    cut[len(data)] = False
    if len(data) > 1:
        space, before = data[1:] == 32, data[:-1]
        wide = np.zeros(len(data), np.bool_)  # whether a white-space character of more than one byte may end here
        wide[1:] = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        wide[2:] |= ((data[:-2] == 0xE1) & (data[1:-1] == 0x9A)) | ((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))) | ((data[:-2] == 0xE3) & (data[1:-1] == 0x80))
        cut[1:-1] |= space & (before > 32) & ~wide[:-1]
    return np.flatnonzero(cut)


_counters: dict[str, PieceCounter] = {}


def counter_for(path: str) -> PieceCounter | None:
    """One counter for all tasks of a worker, of a fixed size; None unless the model's description is that of a byte-level model whose added tokens hold no space and claim none."""
    if path.endswith(".model"):
        return None
    if path not in _counters:
        told = json.loads(load_model(path).to_str())
        steps, added = told.get("pre_tokenizer") or {}, told.get("added_tokens") or []
        plain = told.get("normalizer") is None and steps.get("type") == "ByteLevel" and steps.get("use_regex") and not steps.get("add_prefix_space")
        plain = plain and not any(any(c.isspace() for c in x["content"]) or x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in added)
        marks = [x["content"] for x in added if not x.get("normalized")]
        if not plain or not marks:
            return None
        _counters.clear()
        _counters[path] = PieceCounter(path, marks[0])
    return _counters[path]


def safe_pieces(text: str, piece_chars: int) -> list[str]:
    """Cut text before white space after a non-space, or before a wide punctuation mark after a letter, about every piece_chars; a run without such a place stays whole."""
    if len(text) <= piece_chars:
        return [text]
    out, start = [], 0
    while len(text) - start > piece_chars:
        m = _BOUNDARY.search(text, start + piece_chars)
        if m is None:
            break
        out.append(text[start : m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def _lengths(texts: list[str], encode, batch_bytes: int, piece_chars: int, split: bool) -> np.ndarray:
    total = np.zeros(len(texts), np.int64)
    rows: list[int] = []
    pieces: list[str] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if pieces:
            np.add.at(total, rows, encode(pieces))
        rows.clear()
        pieces.clear()
        held = 0

    for i, text in enumerate(texts):
        for piece in safe_pieces(text, piece_chars) if split else [text]:
            rows.append(i)
            pieces.append(piece)
            held += len(piece) if piece.isascii() else len(piece.encode())
            if held >= batch_bytes:
                flush()
    flush()
    return total


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 1024, batch_bytes: int = 1 << 20, piece_chars: int = 1 << 16) -> DataFrame:
    """key, n_bytes, n_tokens and over_limit of every row's whole text.

    No shuffle: one Arrow pass. For byte-level models the lengths of recurring pieces come from a table of a fixed size (PieceCounter). Encoder calls hold batch_bytes of text each, so one very long text
    neither grows a batch nor holds up its neighbours; it is cut only where the tokenizer would cut too
    (sentencepiece models are not cut). A null text counts as empty: 0 bytes, 0 tokens. Repeated rows
    and null keys stay as they are; other columns, whatever their names, are left out.
    """
    ship(docs.sparkSession)
    split = not tokenizer.endswith(".model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(tokenizer)
        encode = None if counter else load_encoder(tokenizer)
        for b in (s for whole in batches for s in slices(whole, 1, 4096, 8 * batch_bytes)):
            col = b.column(1)
            n = counter.lengths(col.cast(pa.binary()).to_pylist(), piece_chars) if counter else _lengths(col.to_pylist(), encode, batch_bytes, piece_chars, split)
            size = pc.cast(pc.binary_length(col), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], names=[key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text)).mapInArrow(tidy(run), f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
