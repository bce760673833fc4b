"""SentencePiece encoding with the source bytes of every piece, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece as spm
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from sentencepiece import sentencepiece_model_pb2 as pb

from lakeops.llm.words import grouped

SPACE, MARK, BROKEN = " ", "▁", "�"
USER_DEFINED, BYTE = 4, 6
#: Bytes of text whose pieces travel in one batch.
BATCH_BYTES = 1 << 19
ENCODED = "ids array<int>, starts array<int>, ends array<int>, packed binary"


class CharacterMap:
    """The compiled character map of a model: a double-array trie over UTF-8 bytes, and the texts that its leaves name.

    The walk of a character is remembered, so most characters, which begin no entry, cost one look.
    """

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little")
        self._units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self._texts = compiled[4 + size :]
        self._steps: dict[tuple[int, str], tuple[int, str | None] | None] = {}
        self._root = self._below(0) if self._units else 0

    def _below(self, node: int) -> int:
        unit = self._units[node]
        return node ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    def _step(self, base: int, char: str) -> tuple[int, str | None] | None:
        """Where a character leads from a node's children, and the replacement that ends there."""
        found = None
        for byte in char.encode("utf-8", "surrogateescape"):
            node = base ^ byte
            if node >= len(self._units) or self._units[node] & 0x800000FF != byte:
                return None
            base = self._below(node)
            found = None
            if self._units[node] >> 8 & 1:
                begin = self._units[base] & 0x7FFFFFFF
                found = self._texts[begin : self._texts.index(b"\0", begin)].decode()
        return base, found

    def longest(self, text: str, at: int) -> tuple[str, int] | None:
        """Replacement of the longest entry that the text has at a place, and the entry's length; None without one."""
        base, best, end = self._root, None, at
        while end < len(text):
            key = (base, text[end])
            if key not in self._steps:
                self._steps[key] = self._step(*key) if self._units else None
            step = self._steps[key]
            if step is None:
                break
            end += 1
            base = step[0]
            if step[1] is not None:
                best = step[1], end - at
        return best


class Pieces:
    """A model's normalisation, with the source place of every byte, and its pieces over the normalised text."""

    def __init__(self, model: bytes) -> None:
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        self.prefix, self.extra, self.escape = spec.add_dummy_prefix, not spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        own = sorted((p.piece for p in proto.pieces if p.type == USER_DEFINED and p.piece), key=len, reverse=True)
        self.own = re.compile("|".join(map(re.escape, own))) if own else None
        self.blank = MARK if self.escape else SPACE
        self.width = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.whole = spm.SentencePieceProcessor(model_proto=model)
        self.unknown, self.begin, self.end = self.whole.unk_id(), self.whole.bos_id(), self.whole.eos_id()
        # The same pieces over text that is normalised already.
        spec.add_dummy_prefix = spec.escape_whitespaces = spec.remove_extra_whitespaces = False
        spec.precompiled_charsmap = b""
        proto.trainer_spec.treat_whitespace_as_suffix = False
        self.over_normal = spm.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def normal(self, raw: bytes) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the source byte that it comes from."""
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = None
        if text is None or self.map or self.own or not self.extra or self.suffix:
            return self._by_entries(raw.decode("utf-8", "surrogateescape"))
        if not raw:
            return "", np.zeros(1, np.int64)
        data = np.frombuffer(raw, np.uint8)
        # Every byte of a character comes from the character's first one.
        first = np.maximum.accumulate(np.where((data & 0xC0) != 0x80, np.arange(len(data)), 0))
        wide = len(self.blank.encode())
        source = np.repeat(first, np.where(data == 32, wide, 1)) if wide > 1 else first
        lead = self.blank if self.prefix else ""
        return lead + text.replace(SPACE, self.blank), np.r_[np.zeros(len(lead.encode()), np.int64), source, len(data)]

    def _units(self, text: str) -> Iterator[tuple[str, int]]:
        """Normalised pieces of the source in order, each with the source bytes it stands for."""
        at = 0
        while at < len(text):
            kept = self.own.match(text, at) if self.own else None
            if kept:
                out, n = kept[0], len(kept[0])
            else:
                out, n = (self.map.longest(text, at) if self.map else None) or (text[at], 1)
            yield (BROKEN if n == 1 and "\udc80" <= out <= "\udcff" else out), len(text[at : at + n].encode("utf-8", "surrogateescape"))
            at += n

    def _by_entries(self, text: str) -> tuple[str, np.ndarray]:
        out, begin, at, blank_before, started = [], [], 0, not self.extra, False
        for unit, n in self._units(text):
            if not started and not self.extra and unit == SPACE:
                at += n
                continue
            if not started:
                started = True
                if self.prefix and not self.suffix:
                    out.append(SPACE)
                    begin.append(at)
            while blank_before and unit.startswith(SPACE):
                unit = unit[1:]
            if unit:
                out.append(unit)
                begin.append(at)
                blank_before = not self.extra and unit.endswith(SPACE)
            at += n
        if not started:
            return "", np.zeros(1, np.int64)
        normal = [u.replace(SPACE, self.blank) for u in out]
        source = np.repeat(np.array(begin, np.int64), [len(u.encode()) for u in normal])
        text, end = "".join(normal), at
        if not self.extra:
            kept = text.rstrip(self.blank)
            if len(kept) < len(text):
                cut = len(kept.encode())
                text, end, source = kept, int(source[cut]), source[:cut]
        if self.prefix and self.suffix:
            text, source = text + self.blank, np.r_[source, np.full(len(self.blank.encode()), end)]
        return text, np.r_[source, end]

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids without begin and end, and the source bytes from and to which each piece goes."""
        normals = [self.normal(t) for t in texts]
        found = self.over_normal.encode([n for n, _ in normals], return_type="numpy", num_threads=1)
        out = []
        for (normal, source), ids in zip(normals, found):
            width = self.width[ids]
            if (ids == self.unknown).any():
                width = np.array([1 if self.whole.is_byte(int(k)) else len(p.encode()) for k, p in zip(ids, self.over_normal.encode(normal, return_type=str))])
            edge = np.r_[0, np.cumsum(width)]
            if edge[-1] != len(source) - 1:
                raise ValueError("pieces don't add up to the normalised text")
            out.append((ids, source[edge[:-1]], source[edge[1:]]))
        return out


def read_model(path: str) -> bytes:
    """A model's file, read once on the driver and sent along with the tasks: a vocabulary, so its size is bounded."""
    with open(path, "rb") as f:
        return f.read()


def encoded(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """One row for each document: id, ids, starts, ends and packed, and with ``decode`` the text that the ids stand for.

    The text is normalised by the longest entries of the model's character map, which records where each byte comes from;
    the model's pieces over the normalised text are then projected to the source. ``ids`` begin and end with the model's
    own marks, where it has them; piece k stands for the bytes ``starts[k]`` to ``ends[k]`` of the UTF-8 text. Spans rise
    and leave no gap but white space that the model drops; of a character spelt in bytes, the last piece has the whole
    span. ``packed`` holds the ids as little-endian unsigned 32-bit numbers.

    Null counts as empty: only the marks. Texts of any length are encoded whole, in batches of bounded size. Equal rows
    are kept, a null id stays, an empty table gives an empty table, and other columns are not looked at.
    """
    more = ", decoded string" if decode else ""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *T.StructType.fromDDL(ENCODED + more).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces(model)
        lead, tail = ([mark] if mark >= 0 else [] for mark in (own.begin, own.end))
        for batch in batches:
            for first, texts in grouped(batch.column(1).cast(pa.binary()).to_pylist(), BATCH_BYTES):
                rows = [
                    (np.r_[lead, ids, tail], np.r_[[0] * len(lead), starts, [len(t)] * len(tail)], np.r_[[0] * len(lead), ends, [len(t)] * len(tail)])
                    for t, (ids, starts, ends) in zip(texts, own.encode(texts))
                ]
                cut = pa.array(np.cumsum([0, *(len(ids) for ids, _, _ in rows)]), pa.int32())
                lists = [pa.ListArray.from_arrays(cut, pa.array(np.concatenate(c).astype(np.int32))) for c in zip(*rows)]
                packed = pa.array([ids.astype("<u4").tobytes() for ids, _, _ in rows], pa.binary())
                back = [pa.array([own.whole.decode(ids.tolist()) for ids, _, _ in rows], pa.string())] if decode else []
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *lists, packed, *back], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def decoded(rows: DataFrame, model: bytes, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text that their ids stand for, as the model's library decodes it.

    Null ids give null, no ids an empty text. A column of the name ``out`` is replaced.
    """
    kept = rows.drop(out)
    at = kept.columns.index(ids_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = spm.SentencePieceProcessor(model_proto=model)
        names = to_arrow_schema(schema).names
        for batch in batches:
            # One row's ids at a time become Python numbers.
            texts = [own.decode(v.as_py()) if v.is_valid else None for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return kept.mapInArrow(run, schema)
