"""SentencePiece encoding and decoding on a relational lattice.

Encoding. Texts are split into pre-tokens that no piece crosses (see unigram), and these at every place that no piece
crosses. The distinct parts ("words" below) of each chunk of documents go to the word table. There every substring of at
most the longest piece's length is exploded, end by end, and joined to the piece table by equality; a character without a
piece gives an edge of its own, spelt in bytes later. A word's edges are grouped, ordered by end, and folded with Spark's
aggregate function into the best edge of each position, then the path back, as a bit for each place where a piece ends.
Ties go to the longest last piece. The bits return to the chunks that hold the word, where they cut it into pieces.

The piece table is broadcast: its size is that of the vocabulary file, whatever the data. A word is folded once, however
often it occurs; a chunk sends and receives each of its words once, so frequent words cost one row per chunk. Words of
more than BLOCK characters are cut into blocks, which overlap by the longest piece; their folds carry a window of the last
paths from block to block, so a word of any length takes time in proportion to it. encode() raises the number of groups up
to which Spark's object aggregation hashes before it sorts (HASHED), for the session: groups are small.

Decoding maps ids to pieces and bytes; it is the exact inverse for every text without the space mark U+2581 itself, which
decodes to a space.

Null or empty text has no ids. Null doc_id stays null. Repeated rows are encoded each. Empty table: no rows. Further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.chunks import Chunk, map_chunks, pack
from tickframe.llm.common import trim
from tickframe.llm.unigram import SPACE, Vocabulary

CHUNK = 12 << 20
BLOCK = 64
HASHED = 100_000
#: Partitions of the word table for each of the session's: its groups of edges are held as objects.
SPREAD = 3
#: Tokens whose ids are put together at a time.
AT_ONCE = 200_000
#: An edge in a long: its end within the block, score + LEAST, length.
SCORE_AT, END_AT = 6, 21
LEAST = 1 << END_AT - SCORE_AT


class Lookup:
    """The vocabulary as arrays, with spaces instead of marks."""

    def __init__(self, v: Vocabulary):
        plain = [p.replace(SPACE, " ") for p in v.pieces]
        self.pieces = pa.array(plain, pa.string())
        self.ids = np.array([i for i, _ in v.pieces.values()], np.int32)
        self.byte_ids = np.array([v.bytes.get(b, v.unknown_id) for b in range(256)], np.int32)
        self.by_byte = bool(v.bytes)
        spelt = v.spellings()
        self.spelt_len = np.array([len(x) for x in spelt], np.int64)
        self.spelt_at = np.cumsum(self.spelt_len) - self.spelt_len
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        pairs = sorted({p[k : k + 2] for p in plain for k in range(len(p) - 1)})
        chars = sorted(set("".join(pairs)))
        number = {c: k for k, c in enumerate(chars, 1)}
        self.number = np.zeros(0x110000, np.int16)
        self.number[[ord(c) for c in chars]] = range(1, len(chars) + 1)
        self.inside = np.zeros((len(chars) + 1, len(chars) + 1), bool)  # whether a piece may lie across two characters
        self.inside[[number[p[0]] for p in pairs], [number[p[1]] for p in pairs]] = True


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.StringArray:
    """The strings that tile data."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def _bytes(a: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, and the offset of each."""
    offsets = np.frombuffer(a.buffers()[1], np.int32, len(a) + 1, 4 * a.offset)
    data = np.frombuffer(a.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(a) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _chars(data: np.ndarray) -> np.ndarray:
    """The place of each character's first byte."""
    return np.flatnonzero((data & 0xC0) != 0x80)


def gather(values: np.ndarray, starts: np.ndarray, lens: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists at index put end to end, and the end of each."""
    n = lens[index]
    ends = np.cumsum(n)
    at = np.repeat(starts[index] - ends + n, n)
    at += np.arange(len(at))
    return values[at], ends


class Words:
    """Of a chunk: text, a space before each document; begins: of documents; of: the pre-token of each token, first: of documents;
    n_parts: of each pre-token; part_of: the word of each part, pre-token by pre-token; words: sorted; n_chars: of words; data, offsets: their bytes."""

    def __init__(self, c: Chunk, look: Lookup):
        data, lens = c.data, c.lens
        if SPACE.encode() in data.tobytes():
            texts = [data[s : s + n].tobytes().replace(SPACE.encode(), b" ") for s, n in zip(c.starts.tolist(), lens.tolist())]
            data, lens = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)
        some = lens > 0
        self.text = np.insert(data, (np.cumsum(lens) - lens)[some], 32)
        sizes = lens + some
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        line, space = self.text == 10, self.text == 32
        new = line.copy()
        new[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        new[self.begins[some]] = True
        starts = np.flatnonzero(new)
        coded = _strings(self.text, np.append(starts, len(self.text))).dictionary_encode()
        self.of = coded.indices.to_numpy()
        self.first = np.searchsorted(starts, np.append(self.begins, len(self.text)))
        data, offsets = _bytes(coded.dictionary)
        at = _chars(data)
        number = look.number[np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)]
        cut = np.ones(len(at), bool)
        cut[1:] = ~look.inside[number[:-1], number[1:]]
        cut[np.searchsorted(at, offsets[:-1])] = True
        begin = at[cut]
        self.n_parts = np.diff(np.searchsorted(begin, offsets))
        parts = _strings(data, np.append(begin, len(data))).dictionary_encode()
        order = pc.array_sort_indices(parts.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words = parts.dictionary.take(pa.array(order))
        self.part_of = rank[parts.indices.to_numpy()]
        data, offsets = _bytes(self.words)
        self.char_at = _chars(data)
        self.n_chars = np.diff(np.searchsorted(self.char_at, offsets))
        self.data, self.offsets = data, offsets


WORDS = "key string, off int, block string, chunk_id long, at int"


def words_in(before: int, model: str | None = None):
    """From batches of chunks to batches of WORDS: the distinct words of each chunk and their places in order: the key is the word, off 0 and block null.

    A word of more than BLOCK characters has a key of its own in each chunk, and a row for each block: the place where it begins,
    and its text after the characters before it, as many as the longest piece has, less one.
    """

    def run(batches):
        look = Lookup(Vocabulary(model))
        for b in batches:
            for chunk_id, meta, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                w = Words(Chunk(meta, data), look)
                for i in range(0, len(w.words), 50_000):
                    part, size = w.words[i : i + 50_000], w.n_chars[i : i + 50_000]
                    at = np.arange(i, i + len(part), dtype=np.int32)
                    key, off, block = part, np.zeros(len(part), np.int32), pa.nulls(len(part), pa.string())
                    if (size > BLOCK).any():
                        rows = []
                        for place, n, word in zip(at.tolist(), size.tolist(), part.to_pylist()):
                            if n <= BLOCK:
                                rows.append((word, 0, None, place))
                            else:
                                rows += [(f"\n{chunk_id}:{place}", k, word[max(0, k - before) : k + BLOCK], place) for k in range(0, n, BLOCK)]
                        key, off, block, at = zip(*rows)
                    yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(off, pa.int32()), pa.array(block, pa.string()), pa.array(np.full(len(key), chunk_id)), pa.array(at, pa.int32())], names=["key", "off", "block", "chunk_id", "at"])
                del w
                trim()

    return run


def lattice(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """key, off, any, any_at, edge: the edges of the lattice of each block (key, off, block, any, any_at) of a word."""
    spark, longest = words.sparkSession, vocabulary.longest
    if longest >= 1 << SCORE_AT or -vocabulary.unknown >= LEAST:
        raise ValueError("pieces or scores too long for an edge")
    packed = lambda score, length: (score + LEAST << SCORE_AT) + length
    table = pa.table({"piece": [p.replace(SPACE, " ") for p in vocabulary.pieces], "known": pa.array([packed(s, len(p)) for p, (_, s) in vocabulary.pieces.items()], pa.int64())})
    pieces = F.broadcast(spark.createDataFrame(table))
    text = words.select("key", "off", "any", "any_at", F.coalesce("block", "key").alias("text"), F.least(F.lit(longest - 1), "off").alias("before"))
    ends = text.withColumn("finish", F.explode(F.sequence(F.lit(1), F.char_length("text") - F.col("before"))))
    spans = ends.withColumn("len", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.col("finish") + F.col("before")))))
    spans = spans.select("key", "off", "any", "any_at", "finish", "len", F.substring(F.col("text"), F.col("before") + F.col("finish") - F.col("len") + 1, F.col("len")).alias("part"))
    edges = spans.join(pieces, F.col("part") == F.col("piece"), "left").filter(F.col("known").isNotNull() | (F.col("len") == 1))
    known = F.coalesce("known", F.lit(packed(vocabulary.unknown, 1)).cast("long"))
    return edges.select("key", "off", "any", "any_at", (F.shiftleft(F.col("finish").cast("long"), END_AT) + known).alias("edge"))


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def _length(edge: Column) -> Column:
    return edge.bitwiseAND(_long((1 << SCORE_AT) - 1)).cast("int")


def _after(path: Column, edge: Column) -> Column:
    """A path's score carried on by an edge, and below it that edge's length."""
    return path.bitwiseAND(_long(-(1 << SCORE_AT))) + edge.bitwiseAND(_long((1 << END_AT) - 1)) - _long(LEAST << SCORE_AT)


def viterbi(blocks: Column, longest: int) -> Column:
    """For each of a word's blocks (off, edges), in order: bit p - 1 tells whether a piece of the best path ends at p.

    Paths (score, length of the last piece) stand in an array, a place each; a block's fold begins with the last of the block before.
    """

    def forward(t: Column, b: Column) -> Column:
        before = F.size(t.win)

        def fold(s: Column, e: Column) -> Column:
            end = before + F.shiftright(e, END_AT).cast("int")
            path = _after(F.element_at(s, end - _length(e)), e)
            opens = F.size(s) < end  # the first edge into this position
            return F.when(opens, F.concat(s, F.array(path))).when(path > F.element_at(s, -1), F.concat(F.slice(s, F.lit(1), end - 1), F.array(path))).otherwise(s)

        def kept(s: Column) -> Column:
            win = F.slice(s, F.greatest(F.size(s) - (longest - 1), F.lit(1)), F.lit(longest))
            return F.struct(win.alias("win"), F.concat(t.full, F.array(F.slice(s, before + 1, F.size(s) - before))).alias("full"))

        return F.aggregate(b.edges, t.win, fold, kept)

    def back(t: Column, paths: Column) -> Column:
        def bit(u: Column, path: Column) -> Column:
            take = u.skip == 0
            return F.struct(F.when(take, _length(path) - 1).otherwise(u.skip - 1).alias("skip"), (F.shiftleft(u.bits, 1) + F.when(take, _long(1)).otherwise(_long(0))).alias("bits"))

        return F.aggregate(F.reverse(paths), F.struct(t.skip.alias("skip"), _long(0).alias("bits")), bit, lambda u: F.struct(u.skip.alias("skip"), F.concat(F.array(u.bits), t.out).alias("out")))

    start = F.struct(F.array(_long(0)).alias("win"), F.array().cast("array<array<long>>").alias("full"))
    begin = F.struct(F.lit(0).alias("skip"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(blocks, start, forward, lambda t: F.aggregate(F.reverse(t.full), begin, back, lambda u: u.out))


def fold_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """key, any, any_at, bits of each word, of its blocks; words is partitioned by key, so nothing is shuffled."""
    kept = [F.min(c).alias(c) for c in ("any", "any_at")]
    blocks = lattice(words, vocabulary).groupBy("key", "off").agg(F.sort_array(F.collect_list("edge")).alias("edges"), *kept)
    gathered = blocks.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("off", "edges"))).alias("blocks"), *kept)
    return gathered.select("key", "any", "any_at", viterbi(F.col("blocks"), vocabulary.longest).alias("bits"))


def ids_of(w: Words, look: Lookup, at: np.ndarray, off: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all pre-tokens put end to end, where each begins, and how many it has."""
    blocks = -(-w.n_chars // BLOCK)
    first = np.cumsum(blocks) - blocks
    if len(at) != blocks.sum():
        raise RuntimeError("chunks changed between uses: pack them with stored=True")
    held = np.zeros(len(at), np.uint64)
    held[first[at] + off // BLOCK] = bits.view(np.uint64)
    place = np.arange(len(w.char_at)) - np.repeat(np.cumsum(w.n_chars) - w.n_chars, w.n_chars)
    ends = held[np.repeat(first, w.n_chars) + place // BLOCK] >> (place % BLOCK).astype(np.uint64) & np.uint64(1)
    after = np.append(w.char_at[1:], len(w.data))[ends == 1]
    begin = np.append(0, after[:-1]) if len(after) else after
    found = pc.index_in(_strings(w.data, np.append(begin, len(w.data)) if len(after) else np.zeros(1)), value_set=look.pieces)
    lost = found.is_null().to_numpy(zero_copy_only=False)
    n = np.where(lost & look.by_byte, after - begin, 1)
    ids = np.repeat(look.ids[found.fill_null(0).to_numpy()], n)
    if lost.any():  # spelt in bytes
        here = np.repeat(lost, n)
        ids[here] = gather(look.byte_ids[w.data], begin, after - begin, np.flatnonzero(lost))[0] if look.by_byte else look.byte_ids[0]
    words_at = np.searchsorted(begin, w.offsets)
    total = np.append(0, np.cumsum(n))[words_at]
    flat, part_ends = gather(ids, total[:-1], np.diff(total), w.part_of)
    ends = np.append(0, part_ends)[np.cumsum(w.n_parts)] if len(w.n_parts) else np.zeros(0, np.int64)
    counts = np.diff(np.append(0, ends))
    return flat, ends - counts, counts


def _assemble(model: str | None, check: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        look = Lookup(Vocabulary(model))
        at, off, bits = (right[c].to_numpy() for c in ("at", "off", "bits"))
        out = []
        for meta, data in zip(left["meta"].to_pylist(), left["data"].to_pylist()):
            c = Chunk(meta, data)
            w = Words(c, look)
            flat, starts, counts = ids_of(w, look, at, off, bits)
            i, n_docs = 0, len(c.lens)
            while i < n_docs:  # documents of so many tokens at a time
                j = max(i + 1, int(np.searchsorted(w.first, w.first[i] + AT_ONCE, side="right")) - 1)
                of = w.of[w.first[i] : w.first[j]]
                ids, ends = gather(flat, starts, counts, of)
                offsets = np.append(0, ends)[w.first[i : j + 1] - w.first[i]]
                same = None
                if check:
                    text, text_ends = gather(look.spelt, look.spelt_at, look.spelt_len, ids)
                    upto = np.append(0, text_ends)[offsets]
                    lo, hi = w.begins[i:j], w.ends[i:j]
                    if np.array_equal(upto[1:] - upto[:-1], hi - lo) and np.array_equal(text, w.text[lo[0] : hi[-1]]):
                        same = np.ones(j - i, bool)
                    else:
                        same = [np.array_equal(text[a:b], w.text[x:y]) for a, b, x, y in zip(upto[:-1].tolist(), upto[1:].tolist(), lo.tolist(), hi.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                doc_id = pa.array(c.ids[i:j], pa.int64(), mask=c.null[i:j] != 0)
                out.append(pa.table({"doc_id": doc_id, "n_tokens": pa.array(np.diff(offsets), pa.int64()), "ids": lists, "round_trip": pa.array(same, pa.bool_()) if check else pa.nulls(j - i, pa.bool_())}))
                i = j
            del c, w, flat, starts, counts
        trim()
        return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32())), "round_trip": pa.array([], pa.bool_())})

    return run


def encode(docs: DataFrame, model: str | None = None, check: bool = True, stored: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip (whether the pieces and bytes of the ids give the text back), one row per input row.

    stored=False packs the documents again instead of storing chunks; docs must then be read from files.
    """
    vocabulary = Vocabulary(model)
    docs.sparkSession.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(HASHED))
    chunks = pack(docs, CHUNK, stored, 6)
    listed = words_in(vocabulary.longest - 1, model)
    words = chunks.mapInArrow(listed, WORDS) if stored else map_chunks(docs, CHUNK, listed, WORDS)
    words = words.repartition(SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    # all columns are kept so that both uses of words share one shuffle
    distinct = words.groupBy("key", "off", "block").agg(F.min("chunk_id").alias("any"), F.min("at").alias("any_at"))
    folded = fold_words(distinct, vocabulary).filter("any is not null and any_at is not null").select("key", "bits")
    bits = F.element_at("bits", F.when(F.col("block").isNull(), 1).otherwise((F.col("off") / BLOCK).cast("int") + 1))
    back = words.join(folded.hint("shuffle_merge"), "key").select("chunk_id", "at", "off", bits.alias("bits"))
    return chunks.groupBy("chunk_id").cogroup(back.groupBy("chunk_id")).applyInArrow(_assemble(model, check), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text of each row of doc_id and ids."""

    def run(batches):
        v = Vocabulary(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if x is None else v.decode(x) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")
