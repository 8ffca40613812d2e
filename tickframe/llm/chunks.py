"""Documents packed into chunks, and rolling hashes of their bytes.

A chunk is one row: ids, lengths and the compressed bytes of some thousand documents. Chunks are written once to the
shared folder; later steps work on whole chunks with array operations, send small messages to hash or range buckets,
and meet the answers again by chunk_id, so texts are not shuffled document by document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import settle, trim, written

#: Bytes of text in a chunk; a longer document is a chunk of its own. And documents in a chunk.
CHUNK = 8 << 20
MAX_DOCS = 100_000
#: A null doc_id comes after all others.
NO_ID = np.iinfo(np.int64).max

CHUNK_SCHEMA = "chunk_id long, meta binary, data binary"
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def squeeze(a: np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(a).tobytes())


def expand(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=dtype)


def packer(size: int = CHUNK, level: int = 1):
    """From batches of id and text to batches of chunks."""

    def run(batches):
        part, seq, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def emit():
            nonlocal seq, ids, texts, held
            lens = np.array([len(t) for t in texts], dtype=np.int64)
            at = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)
            null = np.array([i is None for i in ids], dtype=np.int64)
            row = [[(part << 24) | seq], [squeeze(np.concatenate([at, lens, null]))], [squeeze(np.frombuffer(b"".join(texts), dtype=np.uint8), level)]]
            seq, ids, texts, held = seq + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), pa.array(row[1], pa.binary()), pa.array(row[2], pa.binary())], names=["chunk_id", "meta", "data"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                if ids and (held + len(raw) > size or len(ids) >= MAX_DOCS):
                    yield emit()
                ids.append(i)
                texts.append(raw)
                held += len(raw)
        if ids:
            yield emit()
        trim()

    return run


def _ids_and_texts(docs: DataFrame) -> DataFrame:
    settle(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("t"))


def pack(docs: DataFrame, size: int = CHUNK, stored: bool = True, level: int = 1) -> DataFrame:
    """Chunks of doc_id and text (null: empty), in the shared folder.

    With stored=False they are packed again at every use, which saves the space; chunk ids then hold only if docs is
    read from files, whose splits do not change between uses.
    """
    out = _ids_and_texts(docs).mapInArrow(packer(size, level), CHUNK_SCHEMA)
    return written(out) if stored else out


def map_chunks(docs: DataFrame, size: int, run, schema: str) -> DataFrame:
    """run over the chunks that pack(docs, size) makes, in the Python workers that make them."""
    make = packer(size)
    return _ids_and_texts(docs).mapInArrow(lambda batches: run(make(batches)), schema)


class Chunk:
    """ids, lens, null, starts and bytes of a chunk."""

    def __init__(self, meta: bytes, data: bytes):
        m = expand(meta, np.int64).reshape(3, -1)
        self.ids, self.lens, self.null = m
        self.data = expand(data, np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.lens)[:-1]]).astype(np.int64) if len(self.lens) else np.zeros(0, np.int64)

    def doc_of(self, n: int | None = None) -> np.ndarray:
        """The index of the document of each byte."""
        return np.repeat(np.arange(len(self.lens), dtype=np.int32), self.lens)


_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo 2 ** 64, for i below n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for v in (_BASE, _INVERSE):
            a = np.full(size, v, dtype=_U)
            a[0] = 1
            _POWERS.append(np.cumprod(a, dtype=_U))
        del _POWERS[:-2]
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """s with s[j] - s[i], times the inverse power of i, a hash of data[i:j]."""
    pw, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum((data.astype(_U) + _U(1)) * pw[: len(data)], out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(29))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(29)
    return h


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, inv = powers(len(sums))
    return mixed((sums[end] - sums[start]) * inv[start] + (end - start).astype(_U) * _U(0x632BE59BD9B4E019))


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each width neighbours."""
    have, m = 1, v
    while have * 2 <= width:
        m = np.minimum(m[: len(m) - have], m[have:])
        have *= 2
    return np.minimum(m[: len(v) - width + 1], m[width - have : width - have + len(v) - width + 1]) if have < width else m


#: Modulus and base of two polynomial hashes; prime, since modulo a power of two words of a known pattern collide for every base.
_PRIME = [((1 << 31) - 1, 1_364_052_193), ((1 << 31) - 19, 1_871_209_801)]
_PRIME_POWERS: dict[int, list[np.ndarray]] = {}


def _prime_powers(p: int, base: int, n: int) -> list[np.ndarray]:
    """base ** i and its inverse modulo p, for i below n."""
    held = _PRIME_POWERS.get(p)
    if held is None or len(held[0]) < n:
        size, held = max(n, 1 << 16), []
        for v in (base, pow(base, -1, p)):
            out = np.ones(size, np.uint32)
            have, step = 1, v
            while have < size:
                out[have : 2 * have] = out[: min(have, size - have)].astype(_U) * _U(step) % _U(p)
                have, step = 2 * have, step * step % p
            held.append(out)
        _PRIME_POWERS[p] = held
    return held


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[begin:end], from 62 bits and the length."""
    n, out = len(data), np.zeros(len(begin), _U)
    for p, base in _PRIME:
        pw, inv = _prime_powers(p, base, n + 1)
        term = (data.astype(_U) + _U(1)) * pw[:n]  # below 2 ** 40
        if n > 1 << 23:
            term %= _U(p)
        sums = np.zeros(n + 1, _U)
        np.cumsum(term, out=sums[1:])
        out = (out << _U(31)) | ((sums[end] - sums[begin]) % _U(p) * inv[begin] % _U(p))
    return mixed(out + (end - begin).astype(_U) * _U(0x632BE59BD9B4E019))
