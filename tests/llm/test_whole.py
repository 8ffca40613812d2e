"""Inputs just past what the operators once left out."""

import random
import string

import numpy as np
import pytest

from tickframe.llm import html_text, jaccard_join, quality, secrets, vector_search


def noise(n, seed=1):
    rng = random.Random(seed)
    return "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))


@pytest.mark.parametrize("quote", "\"'")
@pytest.mark.parametrize("n", [4096, 4097, 100_000])
def test_secrets_in_literals_of_any_length(quote, n):
    literal = noise(n)
    text = f"private_key = {quote}{literal}{quote}\nend"
    assert secrets.redact_text(text, secrets.scan_text(text)[1]) == f"private_key = {quote}[secret]{quote}\nend"


@pytest.mark.parametrize("n", [64, 65, 5000])
def test_secrets_under_names_of_any_length(n):
    name = "x" * (n - len("_credential")) + "_credential"
    text = f'{name} = "{noise(20)}"'
    assert "[secret]" in secrets.redact_text(text, secrets.scan_text(text)[1])


def test_every_literal_of_a_name_is_kept():
    literals = [noise(20, k) + "7" for k in range(200)]
    text = "part = " + " + ".join(f'"{x}"' for x in literals) + "\nwhole = part + part\n" + "whole = whole + whole\n" * 100 + "auth_key = whole"
    red = secrets.redact_text(text, secrets.scan_text(text)[1])
    assert red.count("[secret]") == 200 and not any(x in red for x in literals)


def test_perplexity_rejects_symbol_laden_texts(spark):
    def words(k):
        rng = random.Random(k)
        return [rng.choice("the river runs past old stone houses and under a narrow bridge where children watch slow boats drift".split()) for _ in range(120)]

    clean = [(k, " ".join(words(k)), "en") for k in range(60)]
    marked = [(100 + k, " ".join(w + "*$%&"[i % 4] * 3 for i, w in enumerate(words(100 + k))), "en") for k in range(20)]
    tables = [(200 + k, " | ".join(words(200 + k)), "en") for k in range(20)]
    df = spark.createDataFrame(clean + marked + tables, "doc_id long, text string, lang string")
    for limit in (10**9, 0):
        kept = {r.doc_id for r in quality.quality_report(df, max_broadcast=limit).filter("kept").collect()}
        assert kept == set(range(60))


def test_html_scores_every_path():
    deep = "<body>" + "".join(f"<div>Block {i} has some words, and a mark. It says more, too." for i in range(600))
    wide = "<body>" + "".join(f"<x{i}>Block {i} has some words, and a mark. It says more, too.</x{i}>" for i in range(600))
    for page in (deep, wide):
        text = html_text.main_text(page)
        assert [i for i in range(600) if f"Block {i} " not in text] == []


def test_keep_one_decides_by_row(spark):
    def text(seed, changed=None):
        rng = random.Random(seed)
        words = [f"w{rng.randrange(10_000)}" for _ in range(300)]
        if changed:
            words[150] = changed
        return " ".join(words)

    rows = [(5, text(1))] * 4 + [(6, text(1, "x")), (None, text(1, "y")), (None, text(2)), (None, ""), (7, None), (7, None)]
    rows += [(8, text(3)), (8, ""), (9, text(3, "z")), (9, text(4)), (None, text(5)), (None, text(5, "x"))]
    got = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 8  # components 1 to 5, and the rows without words: null, 7 (once), 8
    assert sum(r.doc_id == 5 for r in got) == 1 and not any(r.doc_id == 6 for r in got)
    assert sorted((r.doc_id, r.text or "") for r in got if r.doc_id) == sorted([(5, text(1)), (7, ""), (8, text(3)), (8, ""), (9, text(4))])
    assert {r.text for r in got if r.doc_id is None} - {text(5), text(5, "x")} == {text(2), ""}


def test_repeated_query_rows_ask_once(spark):
    x = np.random.default_rng(3).normal(size=(60, 8)).round(3)
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(20, x[20].tolist())] * 4 + [(7, x[0].tolist())] * 25
    got = {}
    for r in vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), probe_share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q, v in {0: x[0], 20: x[20]}.items():
        others = rows.copy()
        others.remove((q, v.tolist()))
        want = sorted((-round(float(np.dot(v, w)), 9), i) for i, w in others)[:20]
        assert got[q] == [(k, i) for k, (_, i) in enumerate(want, 1)]
