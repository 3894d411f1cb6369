"""BPE encoding and decoding by content-defined chunks.

A text is cut where a rolling hash over its last bytes has its low bits zero, so texts that
share a passage share its chunks wherever it stands. The inner part of a chunk, from its
first to its last white space, is encoded once and kept by its digest; what stands around
a cut is encoded again together, from the last white space before the cut to the first
after it, across as many chunks as that takes. White space ends every token of the
vocabularies for which this operator is meant, so the ids on both sides of such a span are
those of the whole text: the result agrees exactly with encoding the text at once.

Chunks are kept per Python worker, in a store of bounded bytes, until another operator works there. Sharing them across the
cluster would need a shuffle of all texts and ids, which costs more than it saves (see the
README). Within a chunk, words are looked up in a second bounded store and those not met
before are encoded by the tokenizers library in one batch.

Cases: a NULL text is encoded as the empty one and gives no ids and an empty decoded text;
texts without white space are one span; special tokens written out in a text are encoded
as the library does; other columns pass through, but for those called like a column of the
result, which give way to it; an empty table gives an empty result.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache
from struct import pack, unpack_from

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront.llm.common import set_apart, ship
from storefront.llm.store import ByteStore, hold

WINDOW = 32  # bytes under the rolling hash
MEAN_CHUNK = 1024  # bytes, a power of two
CHUNKS_KEPT = 8 << 20  # bytes of a generation, as below
WORDS_KEPT = 32 << 20
ROWS_AT_ONCE = 256
BASE = 0x9E3779B97F4A7C15 | 1  # odd, so it has an inverse modulo 2**64


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i below ``n``."""
    inverse = pow(BASE, -1, 2**64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, BASE, np.uint64)], dtype=np.uint64)
        down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, inverse, np.uint64)], dtype=np.uint64)
    return up, down


def cuts(data: bytes) -> list[int]:
    """Where the chunks of ``data`` end, by its last WINDOW bytes at each place."""
    n = len(data)
    if n <= WINDOW:
        return [n] if n else []
    size = 1 << max(12, n.bit_length())
    up, down = _powers(size)
    sums = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        rolled = (sums[WINDOW:] - sums[:-WINDOW]) * down[: n - WINDOW + 1]
    mixed = (rolled >> np.uint64(40)) & np.uint64(MEAN_CHUNK - 1)
    ends = np.flatnonzero(mixed == 0) + WINDOW
    found = ends[ends < n].tolist()
    return [*found, n]


def _first_space(data: bytes) -> int:
    """Place of the first white space, or -1."""
    rest = data.split(None, 1)
    if not data or not rest:
        return 0 if data else -1
    if data[:1].isspace():
        return 0
    return len(rest[0]) if len(rest[0]) < len(data) else -1


def _last_space(data: bytes) -> int:
    """Place after the last white space, or -1."""
    if not data:
        return -1
    if data[-1:].isspace():
        return len(data)
    word = data.rsplit(None, 1)[-1]
    return len(data) - len(word) if len(word) < len(data) else -1


class ChunkEncoder:
    """Encodes texts chunk by chunk with the vocabulary in the file ``path``."""

    def __init__(self, path: str):
        # a task has one core: the library's own threads would only cost more
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words, self.chunks = ByteStore(WORDS_KEPT), ByteStore(CHUNKS_KEPT)
        self.encoded_chunks = 0

    def _span(self, data: bytes) -> bytes:
        """Ids, packed, of bytes that begin and end at white space or at an end of the text."""
        found = data.split()
        store, young = self.words, self.words.young.get
        known, fresh = {}, []
        for word in set(found):
            ids = young(word) or store.get(word)
            if ids is None:
                fresh.append(word)
            else:
                known[word] = ids
        if fresh:
            coded = self.tokenizer.encode_batch_fast([w.decode() for w in fresh], add_special_tokens=False)
            for word, e in zip(fresh, coded):
                ids = known[word] = pack("%di" % len(e.ids), *e.ids)
                store.put(word, ids)
        return b"".join(map(known.__getitem__, found))

    def _chunk(self, data: bytes) -> tuple[int, int, bytes]:
        """(end of the head, start of the tail, ids between); -1 where there is no white space."""
        kept = self.chunks.get(data)
        if kept is None:
            head, tail = _first_space(data), _last_space(data)
            kept = pack("=qq", head, tail) + (self._span(data[head:tail]) if head >= 0 else b"")
            self.chunks.put(data, kept)
            self.encoded_chunks += 1
        return *unpack_from("=qq", kept), kept[16:]

    def encode(self, text: str) -> np.ndarray:
        data = text.encode()
        ids: list[bytes] = []
        pending, start = b"", 0  # what waits for white space after a cut
        for end in cuts(data):
            chunk = data[start:end]
            head, tail, inner = self._chunk(chunk)
            if head < 0:
                pending += chunk
            else:
                ids.append(self._span(pending + chunk[:head]))
                ids.append(inner)
                pending = chunk[tail:]
            start = end
        ids.append(self._span(pending))
        return np.frombuffer(b"".join(ids), np.int32)


def _encoder(path: str) -> ChunkEncoder:
    return hold(("bpe", path), lambda: ChunkEncoder(path))


@cache
def _tokens(path: str) -> list[str]:
    tokenizer = _encoder(path).tokenizer
    return [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]


def encode(docs: DataFrame, vocabulary: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` without its text, with ``ids`` and, if asked for, the ``decoded`` text.

    ``vocabulary`` is a tokenizers file that every executor has at that path.
    """
    return set_apart(docs, {text}, lambda inner: _encode(inner, vocabulary, text, decoded))


def _encode(docs: DataFrame, vocabulary: str, text: str, decoded: bool) -> DataFrame:
    ship(docs.sparkSession)
    rest = [f for f in docs.schema.fields if f.name != text]
    added = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        added.append(T.StructField("decoded", T.StringType()))

    names = [f.name for f in (*rest, *added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(vocabulary)
        for batch in batches:
            # only a few rows of a batch are Python objects at a time; the text is its last column
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                *others, texts = batch.slice(at, ROWS_AT_ONCE).columns
                ids = [coder.encode(t or "") for t in texts.to_pylist()]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                others.append(pa.ListArray.from_arrays(ends, np.concatenate(ids)))
                if decoded:
                    others.append(pa.array(decode_ids(ids, vocabulary), pa.string()))
                yield pa.RecordBatch.from_arrays(others, names)

    return docs.select(*[F.col(f"`{f.name}`") for f in rest], F.col(f"`{text}`")).mapInArrow(run, T.StructType([*rest, *added]))


def decode_ids(rows: list[np.ndarray], vocabulary: str) -> list[str]:
    """Texts of ids, special tokens included; by the library where it has a decoder."""
    tokenizer = _encoder(vocabulary).tokenizer
    if tokenizer.decoder is not None:
        return tokenizer.decode_batch([r.tolist() for r in rows], skip_special_tokens=False)
    names = _tokens(vocabulary)
    return [" ".join([names[i] for i in r.tolist()]) for r in rows]


def digests(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids in decimal and of the decoded text."""
    coded = encode(docs.select("doc_id", text), vocabulary, text, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
