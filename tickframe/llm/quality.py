"""Quality rules: base word statistics, and perplexity bands under a Kneser-Ney n-gram model.

Model. n-grams of ORDER UTF-16 units (digits folded to 0, white space to a blank, upper and lower case kept) are
counted per language over all documents with at most SYMBOL_SHARE symbols a word (a model that
has learnt symbol-laden junk finds it probable; such documents are scored like all others): tasks sort their own n-grams and add them up, Spark adds the sums of tasks.
Lower orders use continuation counts, all orders the three discounts of modified Kneser-Ney, estimated per language
and order from counts of counts. The finished model holds, per language and order, an array of sorted 64-bit keys
(the n-gram packed into one word), its log probabilities, and the same for back-off weights of contexts; lookups are
binary searches.

Scoring. If the model has at most max_broadcast n-grams (checked), its arrays go to every task. Beyond that,
documents' distinct n-grams are joined with the model's rows instead, which needs no memory for the model.

Bands. The mean negative log probability of a unit is put into bins of BIN; per language the quartiles of the
documents that pass the base rules give a band from q1 - LOWER * (q2 - q1) * s to q3 + UPPER * (q3 - q2) * s, where
s = sqrt(1 + SHORT / characters), since the mean of a short text scatters more. Documents outside are rejected:
below stands repetition and boilerplate, above gibberish and noise.

Null text: no words, so base_failed. A null language is a language of its own. Empty table: no rows. Repeated rows
are counted and scored each. Further columns are ignored by quality_report and kept by keep_good. Memory: one Arrow
batch, at most AT_ONCE n-grams at a time, and the checked model.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickframe.llm.common import drop_written, release, scratch, settle, trim, written

ORDER = 4
BEGIN, END = 2, 3
AT_ONCE = 2_000_000
#: Rows of bands, one a language, that are broadcast at most.
MOST_LANGUAGES = 100_000
BIN = 0.002
LOWER, UPPER, SHORT = 9.0, 9.0, 500.0
SYMBOLS = "#*$%&|<>"
SYMBOL_SHARE = 0.1
MIN_WORDS = 50
MASKS = [0, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFFFFFF, -1]

_FOLD = np.arange(65536, dtype=np.uint16)
_FOLD[:33] = 32
_FOLD[0x30:0x3A] = 0x30
_FOLD[[0x85, 0xA0, 0x2028, 0x2029, 0x3000]] = 32


# --- base rules -------------------------------------------------------------------------------------------------


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, total, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def base_rules(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    repeats = repeated_words(words)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats, len(words) < MIN_WORDS or 100 * repeats > 50 * len(words)


def laden(text: str | None) -> bool:
    """Whether the text has more than SYMBOL_SHARE symbols a word: it does not train the model."""
    text = text or ""
    symbols = sum(map(text.count, SYMBOLS))
    return symbols > 0 and symbols > SYMBOL_SHARE * len(text.encode("utf-8", "surrogatepass").split())


# --- n-grams ----------------------------------------------------------------------------------------------------


def units(text: str | None) -> np.ndarray:
    """Folded UTF-16 units with marks of begin and end."""
    raw = _FOLD[np.frombuffer((text or "").encode("utf-16-le", "surrogatepass"), dtype="<u2")]
    return np.concatenate([np.full(ORDER - 1, BEGIN, np.uint16), raw, np.array([END], np.uint16)])


def packed(u: np.ndarray) -> np.ndarray:
    """The key of the n-gram that ends at each unit from the ORDER-th on."""
    x = u.astype(np.uint64)
    n = len(x) - ORDER + 1
    key = x[:n] << np.uint64(48)
    for k in range(1, ORDER):
        key |= x[k : k + n] << np.uint64(16 * (ORDER - 1 - k))
    return key


def document_keys(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams of texts, and how many each text has."""
    parts = [units(t) for t in texts]
    keys = packed(np.concatenate(parts))
    last = (keys & np.uint64(0xFFFF)) != BEGIN  # n-grams that end in a begin mark cross texts
    return keys[last], np.array([len(p) - ORDER + 1 for p in parts])


def count_grams(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, key, a: how often each n-gram of ORDER units occurs in texts that are not symbol-laden."""

    def run(batches):
        held: dict[str, list] = {}
        pending: dict[str, list] = {}
        sizes: Counter = Counter()

        def fold(lang):
            keys, _ = document_keys(pending.pop(lang))
            sizes[lang] = 0
            k, c = np.unique(keys, return_counts=True)
            ks, cs = held.setdefault(lang, [[], []])
            ks.append(k)
            cs.append(c)
            if len(ks) > 8:
                held[lang] = [[x] for x in merge(ks, cs)]

        def merge(ks, cs):
            k, inv = np.unique(np.concatenate(ks), return_inverse=True)
            return k, np.bincount(inv, weights=np.concatenate(cs)).astype(np.int64)

        def out():
            for lang, (ks, cs) in held.items():
                k, c = merge(ks, cs)
                for i in range(0, len(k), 100_000):
                    part = k[i : i + 100_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(c[i : i + 100_000])], names=["lang", "key", "a"])
            held.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                if laden(text):
                    continue
                pending.setdefault(lang, []).append(text)
                sizes[lang] += len(text or "") + ORDER
                if sizes[lang] >= AT_ONCE // 4:
                    fold(lang)
            if sum(len(k) for ks, _ in held.values() for k in ks) > 2 * AT_ONCE:
                yield from out()
        for lang in list(pending):
            fold(lang)
        yield from out()

    settle(docs.sparkSession)
    parts = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(run, "lang string, key long, a long")
    return parts.groupBy("lang", "key").agg(F.sum("a").alias("a"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """lang, ord, key, logp, bow: logp of the n-gram key at order ord, bow of the context key of order ord's n-grams."""
    levels = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        above = levels[n + 1]
        levels[n] = written(above.groupBy("lang", F.col("key").bitwiseAND(F.lit(MASKS[n])).alias("key")).agg(F.count("*").alias("a")))
    out, lower = None, None  # every order is stored before the next uses it: plans stay small
    for n in range(1, ORDER + 1):
        grams = levels[n].withColumn("ctx", F.shiftrightunsigned("key", 16))
        t = [F.sum(F.when(F.col("a") == i, 1).otherwise(0)).cast("double").alias(f"t{i}") for i in range(1, 5)]
        disc = grams.groupBy("lang").agg(*t).withColumn("y", F.col("t1") / (F.col("t1") + 2 * F.col("t2")))

        def d(i):
            raw = F.when((F.col("t1") > 0) & (F.col(f"t{i}") > 0), i - (i + 1) * F.col("y") * F.col(f"t{i + 1}") / F.col(f"t{i}")).otherwise(F.lit(0.5 * i))
            return F.least(F.greatest(raw, F.lit(0.05)), F.lit(0.95 * i)).alias(f"d{i}")

        disc = disc.select(F.col("lang").alias("dl"), d(1), d(2), d(3))
        grams = grams.join(disc, F.col("lang").eqNullSafe(F.col("dl")), "left").drop("dl")
        cut = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3"))
        grams = grams.withColumn("cut", cut)
        ctx = written(grams.groupBy(F.col("lang").alias("cl"), F.col("ctx").alias("cc")).agg(F.sum("a").alias("tot"), (F.sum("cut") / F.sum("a")).alias("gamma"), F.count("*").alias("kinds")))
        grams = grams.join(ctx, F.col("lang").eqNullSafe(F.col("cl")) & (F.col("ctx") == F.col("cc")))
        own = (F.col("a") - F.col("cut")) / F.col("tot")
        if n == 1:
            p = own + F.col("gamma") / (F.col("kinds") + 1)
            bows = ctx.select(F.col("cl").alias("lang"), F.lit(0).alias("ord"), F.lit(0).cast("long").alias("key"), F.log(F.col("gamma") / (F.col("kinds") + 1)).alias("logp"), F.lit(None).cast("double").alias("bow"))
        else:
            low = lower.select(F.col("lang").alias("ll"), F.col("key").alias("lk"), F.col("p").alias("lp"))
            suffix = F.col("key").bitwiseAND(F.lit(MASKS[n - 1]))
            grams = grams.join(low, F.col("lang").eqNullSafe(F.col("ll")) & (suffix == F.col("lk")))
            p = own + F.col("gamma") * F.col("lp")
            bows = ctx.select(F.col("cl").alias("lang"), F.lit(n).alias("ord"), F.col("cc").alias("key"), F.lit(None).cast("double").alias("logp"), F.log("gamma").alias("bow"))
        lower = written(grams.select("lang", "key", p.alias("p")))
        rows = lower.select("lang", F.lit(n).alias("ord"), "key", F.log("p").alias("logp"), F.lit(None).cast("double").alias("bow")).unionByName(bows)
        out = rows if out is None else out.unionByName(rows)
    return out


class Arrays:
    """Sorted keys with values, per language and order."""

    def __init__(self, rows: pa.Table):
        self.p: dict = {}
        self.b: dict = {}
        coded = rows["lang"].combine_chunks().dictionary_encode()
        coded = coded.chunk(0) if hasattr(coded, "chunk") else coded
        code = {v: i for i, v in enumerate(coded.dictionary.to_pylist())}
        which, ords = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False), rows["ord"].to_numpy()
        if (which < 0).any():
            code[None] = -1
        keys = rows["key"].to_numpy().view(np.uint64)
        logp, bow = (rows[c].to_numpy(zero_copy_only=False) for c in ("logp", "bow"))
        for lang, i in code.items():
            for n in range(ORDER + 1):
                for store, values in ((self.p, logp), (self.b, bow)):
                    at = np.flatnonzero((which == i) & (ords == n) & ~np.isnan(values))
                    at = at[np.argsort(keys[at])]
                    store[lang, n] = (keys[at], values[at])

    @staticmethod
    def find(store, keys: np.ndarray) -> np.ndarray:
        """Values of keys; NaN where there is none."""
        known, values = store
        if not len(known):
            return np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, values[at], np.nan)

    def logp(self, lang, keys: np.ndarray) -> np.ndarray:
        if (lang, ORDER) not in self.p:
            return np.full(len(keys), -np.log(65536.0))
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        for n in range(ORDER, 0, -1):
            k = keys[left] & np.uint64(MASKS[n] & 0xFFFFFFFFFFFFFFFF)
            found = self.find(self.p[lang, n], k)
            miss = np.isnan(found)
            out[left[~miss]] += found[~miss]
            left = left[miss]
            if not len(left):
                return out
            if n > 1:
                out[left] += np.nan_to_num(self.find(self.b[lang, n], k[miss] >> np.uint64(16)))
        out[left] += self.p[lang, 0][1][0]
        return out


def model_rows(docs: DataFrame) -> DataFrame:
    """The finished model in the shared folder."""
    counts = written(count_grams(docs))
    release(docs.sparkSession)
    return kneser_ney(counts)


# --- scoring ----------------------------------------------------------------------------------------------------

RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _score_with_arrays(docs: DataFrame, model: DataFrame, keep: list[str]) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Arrays(model.toArrow()))

    def run(batches):
        arrays = shared.value

        def scored(langs, texts):
            out: list[float] = [0.0] * len(texts)
            groups: dict = {}
            for i, lang in enumerate(langs):
                groups.setdefault(lang, []).append(i)
            for lang, at in groups.items():
                while at:  # at most AT_ONCE units at a time, or one text
                    n, size = 0, 0
                    while n < len(at) and (n == 0 or size < AT_ONCE // 4):
                        size += len(texts[at[n]] or "")
                        n += 1
                    keys, sizes = document_keys([texts[i] for i in at[:n]])
                    ends = np.cumsum(sizes)
                    sums = np.add.reduceat(arrays.logp(lang, keys), ends - sizes)
                    for i, s, m in zip(at[:n], sums, sizes):
                        out[i] = float(-s / m)
                    at = at[n:]
            return out

        for b in batches:
            langs, texts = b.column(len(keep)).to_pylist(), b.column(len(keep) + 1).to_pylist()
            rules = list(zip(*[base_rules(t) for t in texts])) if texts else [[]] * 6
            cols = [*b.columns[: len(keep)], b.column(len(keep)), *[pa.array(r, pa.int64()) for r in rules[:5]], pa.array(rules[5], pa.bool_()), pa.array(scored(langs, texts), pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*[f"c{i}" for i in range(len(keep))], "_lang", *RULES, "base_failed", "nll"])
        trim()

    types = docs.select(*keep).schema
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(types)], "_lang string", *[f"{r} long" for r in RULES], "base_failed boolean", "nll double"])
    return docs.select(*keep, F.col("lang").alias("_l"), F.col("text").alias("_t")).mapInArrow(run, schema)


def _score_with_joins(docs: DataFrame, model: DataFrame, keep: list[str]) -> DataFrame:
    """As _score_with_arrays for a model of any size: distinct n-grams of each document meet the model's rows in joins."""
    rows = written(docs.select(*keep, F.col("lang").alias("_l"), F.col("text").alias("_t")).withColumn("_row", F.monotonically_increasing_id()))

    def grams(batches):
        for b in batches:
            for row, lang, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                k, c = np.unique(document_keys([text])[0], return_counts=True)
                for i in range(0, len(k), 100_000):
                    part = k[i : i + 100_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([row] * len(part), pa.int64()), pa.array([lang] * len(part), pa.string()), pa.array(part), pa.array(c[i : i + 100_000])], names=["row", "lang", "key", "n"])

    found = rows.select("_row", "_l", "_t").mapInArrow(grams, "row long, lang string, key long, n long")
    total = F.col("f0")
    for n in range(ORDER + 1):
        part = model.filter((F.col("ord") == n) & F.col("logp").isNotNull()).select(F.col("lang").alias("ml"), F.col("key").alias("mk"), F.col("logp").alias(f"f{n}"))
        key = F.col("key").bitwiseAND(F.lit(MASKS[n])) if n else F.lit(0).cast("long")
        found = found.join(part, F.col("lang").eqNullSafe(F.col("ml")) & (key == F.col("mk")), "left").drop("ml", "mk")
        if n == 1:
            total = F.coalesce(F.col("f1"), F.col("f0"))
        elif n > 1:
            back = model.filter((F.col("ord") == n) & F.col("bow").isNotNull()).select(F.col("lang").alias("ml"), F.col("key").alias("mk"), F.col("bow").alias(f"b{n}"))
            found = found.join(back, F.col("lang").eqNullSafe(F.col("ml")) & (F.shiftrightunsigned(key, 16) == F.col("mk")), "left").drop("ml", "mk")
            total = F.coalesce(F.col(f"f{n}"), F.coalesce(F.col(f"b{n}"), F.lit(0.0)) + total)
    sums = found.groupBy(F.col("row").alias("_sum_row")).agg((-F.sum(F.col("n") * F.coalesce(total, F.lit(-float(np.log(65536.0))))) / F.sum("n")).alias("nll"))

    def rules(batches):
        for b in batches:
            got = list(zip(*[base_rules(t) for t in b.column(1).to_pylist()])) or [[]] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(r, pa.int64()) for r in got[:5]], pa.array(got[5], pa.bool_())], names=["_rule_row", *RULES, "base_failed"])

    base = rows.select("_row", "_t").mapInArrow(rules, ", ".join(["_rule_row long", *[f"{r} long" for r in RULES], "base_failed boolean"]))
    names = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    out = rows.drop("_t").join(base, F.col("_row") == F.col("_rule_row")).join(sums, F.col("_row") == F.col("_sum_row"))
    return out.select(*names, F.col("_l").alias("_lang"), *RULES, "base_failed", "nll")


def bands(scored: DataFrame) -> DataFrame:
    """_band_lang, q1, q3, below, above: one row a language, from bin counts of the documents that pass the base rules."""
    bins = scored.filter("not base_failed").groupBy("_lang", F.floor(F.col("nll") / BIN).alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("_lang").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy("_lang")))
    q = [F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("bin"))).alias(f"q{i}") for i, share in enumerate((0.25, 0.5, 0.75), 1)]
    quart = bins.groupBy(F.col("_lang").alias("_band_lang")).agg(*q)
    low, high = F.greatest(F.col("q2") - F.col("q1"), F.lit(1)), F.greatest(F.col("q3") - F.col("q2"), F.lit(1))
    return quart.select("_band_lang", *[(c * BIN).alias(n) for c, n in ((F.col("q1"), "q1"), (F.col("q3"), "q3"), (LOWER * low, "below"), (UPPER * high, "above"))])


def score(docs: DataFrame, keep: list[str], max_broadcast: int = 4_000_000) -> DataFrame:
    """c0, c1, ... (the columns keep), _lang, the base rules, nll, low, high, kept: one row per input row."""
    with scratch() as made:
        model = model_rows(docs)
        way = _score_with_arrays if model.count() <= max_broadcast else _score_with_joins
        scored = written(way(docs, model, keep))
        limits = written(bands(scored))
        for t in made:
            if t is not scored and t is not limits:
                drop_written(t)
    release(docs.sparkSession)
    if limits.count() <= MOST_LANGUAGES:  # else documents meet their language's band in a join
        limits = F.broadcast(limits)
    out = scored.join(limits, F.col("_lang").eqNullSafe(F.col("_band_lang")), "left").drop("_band_lang")
    wider = F.sqrt(1 + SHORT / (F.col("word_chars") + F.col("n_words") + 1))
    out = out.withColumn("low", F.col("q1") - F.col("below") * wider).withColumn("high", F.col("q3") + F.col("above") * wider)
    inside = F.coalesce(F.col("nll").between(F.col("low"), F.col("high")), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & inside)


def quality_report(docs: DataFrame, max_broadcast: int = 4_000_000) -> DataFrame:
    """doc_id, the base rules, base_failed, kept, and the perplexity of a unit with its band."""
    out = score(docs, ["doc_id"], max_broadcast)
    return out.select(F.col("c0").alias("doc_id"), *RULES, "base_failed", "kept", F.exp("nll").alias("perplexity"), F.exp("low").alias("band_low"), F.exp("high").alias("band_high"))


def keep_good(docs: DataFrame, max_broadcast: int = 4_000_000) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    out = score(docs, docs.columns, max_broadcast).filter("kept")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
