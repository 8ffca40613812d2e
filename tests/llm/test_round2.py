"""Cases that came up in use: long words, colliding words, repeated rows, large groups of near copies."""

import random

import numpy as np
import pytest

from tests.llm.test_llm import best_path, plain_links
from tickframe.llm import chunks, jaccard_join, sentencepiece_lattice, unigram


def long_words():
    rng = random.Random(5)
    soup = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    sizes = (1, 15, 16, 17, 63, 64, 65, 79, 80, 127, 128, 129, 1000, 4000)
    return [soup(n, letters) for n in sizes for letters in ("a", "etaoin", "eéß你x")] + ["a" * 70 + "\n" + "a" * 70 + " \n  b", "▁a ▁▁b", "\n\n", " ", "x\x00y 1234567890" * 9]


def test_words_of_any_length(spark):
    texts = long_words()
    rows = sentencepiece_lattice.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    v = unigram.Vocabulary()
    assert len(rows) == len(texts)
    for r in rows:
        assert list(r.ids) == [i for w in unigram.pretokens(texts[r.doc_id]) for i in best_path(w, v)], texts[r.doc_id][:80]
        assert r.n_tokens == len(r.ids) and r.round_trip


def test_time_follows_the_length_of_a_word(spark):
    import time

    took = []
    for n in (1000, 20_000, 160_000):
        docs = spark.createDataFrame([(1, "a" * n), (2, "thein" * (n // 5))], "doc_id long, text string")
        begin = time.time()
        assert [r.round_trip for r in sentencepiece_lattice.encode(docs).collect()] == [True, True]
        took.append(time.time() - begin)
    assert took[2] < 5 + 8 * 3 * took[1]


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[i.bit_count() & 1] for i in range(n))


def test_words_that_collide_modulo_powers_of_two(spark):
    one, two = thue_morse(4096), thue_morse(4096, "b", "a")
    data = np.frombuffer((one + two).encode(), np.uint8)
    h = chunks.word_hashes(data, np.array([0, 4096]), np.array([4096, 8192]))
    assert h[0] != h[1]
    rows = {r.doc_id: r.component_id for r in jaccard_join.link_report(spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")).collect()}
    assert rows == {1: 1, 2: 2, 3: 1}


def near_copies(rng, template, n, first, most):
    rows = []
    for k in range(n):
        w = list(template)
        for _ in range(rng.randrange(1, most)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(40)}"
        rows.append((first + k, " ".join(w)))
    return rows


@pytest.mark.parametrize("far, near, matches", [(512, 2048, 4_000_000), (7, 11, 50)])
def test_large_groups_of_near_copies(spark, monkeypatch, far, near, matches):
    for name, value in (("FAR", far), ("NEAR", near), ("MATCHES", matches), ("SMALL", 8)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(far)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for g in range(3):
        template = [f"t{g}x{rng.randrange(500)}" for _ in range(100)]
        rows += near_copies(rng, template, 70, 1000 * g, 6)
        other = template[:60] + [f"u{g}x{i}" for i in range(40)]  # a second version, not linked with the first
        rows += near_copies(rng, other, 40, 1000 * g + 500, 5)
        rows += near_copies(rng, template[: 100 - 12 * (g + 1)], 30, 1000 * g + 700, 5)
        rows += [(1000 * g + 900 + k, " ".join(passage + [f"v{g}y{k}z{i}" for i in range(30)])) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.link_report(df).collect())
    assert got == plain_links(rows)
