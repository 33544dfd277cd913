"""SentencePiece encoding and decoding by a streaming Viterbi."""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"


def _between_boundaries(pieces: Iterable[str]) -> re.Pattern | None:
    """A pattern of what stands between two boundaries that no piece crosses, as far as kinds of characters tell: no
    piece with a space after another character, none with a letter beside another sign. None if some piece has."""
    pieces = list(pieces)
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
        return None
    letters = "[" + "".join(re.escape(c) for c in sorted({c for p in pieces for c in p if c.isalpha()})) + "]"
    others = f"[^{SPACE}{letters[1:]}"
    if letters == "[]" or any(re.search(f"{letters}{others}|{others}{letters}", p) for p in pieces):
        return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
    return re.compile(f"{SPACE}*{letters}+|{SPACE}*{others}+|{SPACE}+")


class PieceCodec:
    """Best segmentation of a text under a model's piece scores, with byte fallback.

    The vocabulary's normal pieces with their scores are the arcs; a character that is no piece costs more than any
    piece and is written as its bytes. Ties go to the longer last piece. Spaces become U+2581 and one is put in front
    of a text that isn't empty; a literal U+2581 in a text is written as its bytes, so decoding is exact.

    Positions further back than the longest piece can't be reached, so only that window of scores is kept. When all
    surviving paths go through one boundary, the ids before it are final and leave the window. Between two characters
    that no piece holds side by side there is such a boundary on every path, whatever the scores: there the window
    always commits, and what it commits from one of these to the next depends on these characters alone, so it is
    remembered by them.
    """

    def __init__(self, model: bytes, cache: int = 1 << 17):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(size) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.table = {names[i]: (sp.get_score(i), i) for i in range(size) if i not in special}
        self.bytes = [b"" if i in special else names[i].replace(SPACE, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        self.window = max(map(len, self.table))
        # The pieces as a tree: for a character what may follow, the score and the id, which is -1 for a mere beginning.
        self.tree: dict = {}
        for p, (score, i) in self.table.items():
            at = self.tree
            for c in p[:-1]:
                at = at.setdefault(c, [{}, 0.0, -1])[0]
            at.setdefault(p[-1], [{}, 0.0, -1])[1:] = [score, i]
        self.lowest = min(s for s, _ in self.table.values() if s > -1e8) - 10
        self.split = _between_boundaries(self.table)
        self.known, self.older, self.most = {}, {}, cache  # two generations: memory is bounded, frequent chunks stay

    def stream(self, parts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a stream of strings (spaces as U+2581), given out as soon as they are final."""
        tree, reach, lowest, byte_ids = self.tree, self.window, self.lowest, self.byte_ids
        parts, text, ended = iter(parts), "", False  # the text from the last commit on
        best, back, arcs = [0.0], [0], [0]  # by position: score, length and id of the last piece; -1: bytes
        start = 0

        def path(end: int) -> list[int]:
            ids = []
            while end:
                ids += [byte_ids[b] for b in reversed(text[end - 1].encode())] if arcs[end] < 0 else [arcs[end]]
                end -= back[end]
            return ids[::-1]

        while not ended or start < len(text):
            while not ended and len(text) - start < reach:
                more = next(parts, None)
                ended = more is None
                text += more or ""
            new = len(text) + 1 - len(best)
            best += [-inf] * new
            back += [0] * new
            arcs += [0] * new
            for start in range(start, len(text) if ended else len(text) - reach + 1):
                so_far, node, end = best[start], tree, start
                for c in text[start : start + reach]:
                    node = node.get(c)
                    if node is None:
                        break
                    end += 1
                    node, score, i = node
                    if i >= 0 and so_far + score > best[end]:
                        best[end], back[end], arcs[end] = so_far + score, end - start, i
                if so_far + lowest > best[start + 1] and ((only := tree.get(text[start])) is None or only[2] < 0):
                    best[start + 1], back[start + 1], arcs[start + 1] = so_far + lowest, 1, -1
                if start + 1 >= 2 * reach:  # look for the boundary that all survivors share
                    live = {e for e in range(start + 1, min(start + reach, len(text)) + 1) if best[e] > -inf}
                    while len(live) > 1:
                        last = max(live)
                        live.discard(last)
                        live.add(last - back[last])
                    common = live.pop()
                    if common > 0:
                        yield path(common)
                        text, best, back, arcs = text[common:], best[common:], back[common:], arcs[common:]
                        start -= common
                        break
            start += 1
        if text:
            yield path(len(text))

    def _learn(self, chunk: str) -> bytes:
        ids = self.older.get(chunk) or b"".join([array("i", ids).tobytes() for ids in self.stream((chunk,))])
        if len(chunk) <= 4 * self.window:  # what is longer hardly comes again
            if len(self.known) >= self.most:
                self.known, self.older = {}, self.known
            self.known[chunk] = ids
        return ids

    def _part(self, text: str) -> bytes:
        return b"".join([self.known.get(c) or self._learn(c) for c in (self.split.findall(text) if self.split else [text])]) if text else b""

    def encode(self, text: str) -> bytes:
        """Ids as little-endian int32."""
        if not text:
            return b""
        parts = (" " + text).split(SPACE)
        literal = np.asarray([self.byte_ids[b] for b in SPACE.encode()], np.int32).tobytes()
        return literal.join(self._part(p.replace(" ", SPACE)) for p in parts)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids))[1:].decode("utf-8", "replace")


def codec_of(model: bytes) -> PieceCodec:
    """One codec a process for each model: a reused Python worker keeps what its codec has learnt of words."""
    key = "_piece_codec_" + hashlib.sha256(model).hexdigest()
    if key not in sys.modules:
        sys.modules[key] = PieceCodec(model)
    return sys.modules[key]


def encode(docs: DataFrame, model_path: str, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default) plus a struct `pieces`: ids, n_ids, exact (decoding gives the text back).

    The model file is read on the driver and goes to the tasks by value. Whole texts are encoded, of any length: the
    memory of a text is its ids. A null text has null ids, n_ids 0 and exact true; the empty text has no ids. Repeated
    rows get equal ids; an empty table gives an empty result. `docs` may have columns of any names but `pieces`.
    """
    from pyspark.sql.types import StructType

    from .toxicity import batches

    with open(model_path, "rb") as f:
        model = f.read()
    names = keep if keep is not None else docs.columns
    schema = StructType([*(docs.schema[c] for c in names), *StructType.fromDDL("pieces struct<ids:array<int>,n_ids:bigint,exact:boolean>").fields])

    def run(parts):
        codec = codec_of(model)
        for part in parts:
            column = part.column(part.schema.get_field_index(text))
            for start, texts in batches(column):
                codes = [codec.encode(t or "") for t in texts]
                exact = [codec.decode(np.frombuffer(c, np.int32).tolist()) == (t or "") for c, t in zip(codes, texts)]
                ends = np.zeros(len(codes) + 1, np.int32)
                np.cumsum([len(c) // 4 for c in codes], out=ends[1:])
                null = np.array([t is None for t in texts])
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(codes), np.int32)), mask=pa.array(null))
                out = pa.StructArray.from_arrays([ids, pa.array(np.diff(ends).astype(np.int64)), pa.array(exact)], ["ids", "n_ids", "exact"])
                rest = [part.column(part.schema.get_field_index(c)).slice(start, len(texts)) for c in names]
                yield pa.RecordBatch.from_arrays([*rest, out], names=[*names, "pieces"])

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str, *, ids: str = "ids", to: str = "text") -> DataFrame:
    """Every row plus the column `to`: the text of its ids; null ids give null."""
    from pyspark.sql.types import StructType

    with open(model_path, "rb") as f:
        model = f.read()
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(f"`{to}` string").fields])

    def run(parts):
        codec = codec_of(model)
        for part in parts:
            texts = [None if x is None else codec.decode(x) for x in part.column(part.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, to])

    return rows.mapInArrow(run, schema)
