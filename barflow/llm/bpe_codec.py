"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last 32 bytes cuts texts into chunks, so equal passages
fall into equal chunks wherever they stand. A worker encodes each chunk once
and keeps it in a bounded cache. A cut may fall anywhere, also inside a word,
so the two sides of a join are encoded again together, reaching out to the
nearest safe boundary on either side (through whole chunks, if need be): there
the encoding of the join and those of the chunks agree exactly, as pre-tokens
never cross it (see ``byte_bpe``). Nothing is shuffled, so no key can be hot.

The ids of a chunk come from a cache of short units; the text is decoded from
the vocabulary's bytes.

Defined results: null text is encoded as empty (no ids, empty text); repeated
rows are encoded each; an empty table gives no rows; other columns travel in
``row``.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.byte_bpe import SAFE, PreTokens, Units, byte_alphabet, load_tokenizer, splits_at_spaces
from barflow.llm.shared import packed, require

# A cut falls after a byte whose hash has these bits clear: 512 bytes on average.
CUT_MASK = np.uint32(0xFF800000)
LEAST_CHUNK = 64
# Bytes of chunk text that a worker's cache holds before it is emptied.
CHUNK_BYTES = 8 << 20
GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)

_CODECS: dict[str, Codec] = {}


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes that end at each place: sum of GEAR[b] shifted by age."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        out = h.copy()
        out[step:] += h[:-step] << np.uint32(step)
        h = out
    return h


def cuts(data: bytes) -> list[int]:
    """Where chunks end, on character boundaries; the last is the end of the text."""
    if len(data) <= LEAST_CHUNK:
        return [len(data)]
    raw = np.frombuffer(data, np.uint8)
    out, last, end = [], 0, len(data)
    for at in (np.flatnonzero((rolling_hash(raw) & CUT_MASK) == 0) + 1).tolist():
        while at < end and data[at] & 0xC0 == 0x80:
            at += 1
        if at - last >= LEAST_CHUNK and at < end:
            out.append(at)
            last = at
    return [*out, end]


def last_safe(text: str) -> int:
    """Place of the last safe boundary, -1 if there is none."""
    at = text.rfind(" ")
    while at >= 0:
        if 0 < at < len(text) - 1 and not text[at - 1].isspace() and not text[at + 1].isspace():
            return at
        at = text.rfind(" ", 0, at)
    return -1


class Codec:
    def __init__(self, path: str) -> None:
        self.tokenizer = load_tokenizer(path)
        self.fast = splits_at_spaces(self.tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if self.fast:
            self.pre_tokens = PreTokens(self.tokenizer)
            self.units = Units(self._unit)
        self.chunks: dict[bytes, tuple[str, bytes, str]] = {}
        self.held = 0
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.names = [str(i) for i in range(size)]
        self.bytes = self._token_bytes(size) if self.fast else None

    def _token_bytes(self, size: int) -> list[bytes]:
        back = {c: b for b, c in enumerate(byte_alphabet())}
        added = self.tokenizer.get_added_tokens_decoder()
        out = []
        for i in range(size):
            word = self.tokenizer.id_to_token(i)
            out.append(word.encode() if i in added or word is None else bytes(back[c] for c in word))
        return out

    def _unit(self, text: str) -> bytes:
        """Ids of a unit, four bytes each: a cache of many tuples of numbers would take three times the memory."""
        ids = [t.id for part in self.pre_tokens(text) for t in self.tokenizer.model.tokenize(part)]
        return array("I", ids).tobytes()

    def _chunk(self, data: bytes) -> tuple[str, bytes, str]:
        """Text before the first safe boundary, ids up to the last, text after it."""
        found = self.chunks.get(data)
        if found is not None:
            return found
        text = data.decode()
        first = SAFE.search(text)
        if first is None:
            found = (text, b"", "")
        else:
            a, b = first.start(), last_safe(text)
            ids = b"".join(self.units.after_space(text[a:b])) if b > a else b""
            found = (text[:a], ids, text[b:])
        self.held += len(data)
        if self.held > CHUNK_BYTES:
            self.chunks.clear()
            self.held = len(data)
        self.chunks[data] = found
        return found

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if not self.fast or any(token in text for token in self.added):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        data = text.encode()
        ids: list[bytes] = []
        start, open_end = 0, []
        for end in cuts(data):
            head, middle, tail = self._chunk(data[start:end])
            start = end
            open_end.append(head)
            if not tail:
                continue  # no safe boundary in the chunk: the join reaches on
            ids += self.units.of("".join(open_end))
            ids.append(middle)
            open_end = [tail]
        ids += self.units.of("".join(open_end))
        return array("I", b"".join(ids)).tolist()

    def decode(self, ids: list[int]) -> str:
        if self.bytes is None:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def encoded(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``row`` (the other columns), ids (list of int) and decoded (the text made of them again)."""
    return _mapped(docs, tokenizer, text, "ids array<int>, decoded string", _lists)


def digests(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``row``, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256."""
    return _mapped(docs, tokenizer, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _hashes)


def _lists(codec: Codec, texts: pa.Array) -> list[pa.Array]:
    ids = [codec.encode(t.as_py()) for t in texts]
    return [pa.array(ids, pa.list_(pa.int32())), pa.array(map(codec.decode, ids), pa.string())]


def _hashes(codec: Codec, texts: pa.Array) -> list[pa.Array]:
    counts, of_ids, of_text = [], [], []
    for t in texts:
        ids = codec.encode(t.as_py())
        counts.append(len(ids))
        of_ids.append(hashlib.sha256(",".join(map(codec.names.__getitem__, ids)).encode()).hexdigest())
        of_text.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]


def _mapped(docs: DataFrame, tokenizer: str, text: str, columns: str, make) -> DataFrame:
    require(docs, text)
    names = ["row", *[c.split()[0] for c in columns.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _CODECS.get(tokenizer)
        if codec is None:
            codec = _CODECS[tokenizer] = Codec(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *make(codec, batch.column(1))], names)

    rest = docs.drop(text)
    row = packed(rest) if rest.columns else F.struct(F.lit(None).cast("string").alias("none"))
    rows = docs.select(row.alias("row"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, {columns}")
