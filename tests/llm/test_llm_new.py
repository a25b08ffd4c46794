"""Language id, vector codes and lexical search against plain versions of their contracts."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest

from crmfunnel.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, extra string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, row long"


def plain_terms(text):
    if text is None:
        return []
    return TERM.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def plain_search(docs, items, k=10):
    """The contract, row by row."""
    rows = [(i, plain_terms(t)) for i, t in docs]
    big_n = sum(1 for _, t in rows if t)
    big_l = sum(len(t) for _, t in rows)
    df = {}
    for _, t in rows:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(plain_terms(text))
    out = set()
    for item, want in asked.items():
        found = []
        for pos, (i, t) in enumerate(rows):
            if not t:
                continue
            m = 100 - 90 + (90 * len(t) * big_n) // big_l
            score = 0
            for x in want:
                tf = t.count(x)
                if tf:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[x] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, i if i is not None else float("inf"), pos, i, score))
        for rank, f in enumerate(sorted(found)[:k], 1):
            out.add((item, rank, f[3], f[4]))
    return out


def search_rows(rng):
    words = ["alpha", "Beta", "GAMMA", "delta", "été", "x9", "the", "of", "Über", "and"]
    docs = []
    for i in range(400):
        n = int(rng.integers(0, 60))
        docs.append((i, " ".join(rng.choice(words, n)) + rng.choice(["", ".", ", 7!"])))
    docs += [(400, None), (401, ""), (402, "... !!! ,,,"), (403, "alpha " * 5000), (7, docs[7][1]), (7, docs[7][1]),
             (None, "beta gamma"), (404, docs[10][1]), (405, docs[10][1])]
    items = [(1, "Alpha beta"), (2, "the of and"), (3, "über été"), (3, "delta"), (4, None), (5, "zzz"), (None, "gamma x9"),
             (6, "ALPHA alpha alpha")]
    return docs, items


def frame(spark, docs, items):
    d = spark.createDataFrame([(i, t, "en", "s", 0, 1, 2) for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    return d, q


def test_lexical_search_is_the_contract(spark):
    docs, items = search_rows(np.random.default_rng(5))
    d, q = frame(spark, docs, items)
    got = {tuple(r) for r in lexical.search(d, q).collect()}
    assert got == plain_search(docs, items)
    assert {r[0] for r in got} >= {1, 2, 3, 6, None}


def test_lexical_search_threshold_matches_a_full_scan(spark):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(1, 300))))) for i in range(600)]
    items = [(j, " ".join(rng.choice(words, 3))) for j in range(12)]
    d, q = frame(spark, docs, items)
    assert {tuple(r) for r in lexical.search(d, q, 3).collect()} == plain_search(docs, items, 3)


def test_lexical_postings_are_counted_without_an_exchange(spark, monkeypatch):
    docs, items = search_rows(np.random.default_rng(5))
    d, q = frame(spark, docs, items)
    plans = {}

    def noted(df, name, write=lexical.stage):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(lexical, "stage", noted)
    assert {tuple(r) for r in lexical.search(d, q).collect()} == plain_search(docs, items)
    exchanges = [x for x in plans["lexical_postings"].splitlines() if re.search(r"\bExchange hashpartitioning", x)]
    assert not [x for x in exchanges if "row#" in x]
    # distinct terms are found once a text: a filter inferred from them would find them for each term
    assert plans["lexical_postings"].count("filter(sequence(") == 1
    # terms are found once in the documents and once in the items, not again for each place in a text
    assert plans["lexical_postings"].count("regexp_extract_all") == 2


def test_lexical_items_terms_are_written_to_few_files(spark, monkeypatch):
    """Many small files are mostly footers, whose size kept the few rows from being broadcast."""
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(rng.choice(words, 40))) for i in range(300)]
    items = [(j, " ".join(rng.choice(words, 10))) for j in range(20)]
    d, q = frame(spark, docs, items)
    files = {}

    def noted(df, name, write=lexical.stage):
        out = write(df, name)
        files.setdefault(name, len(out.inputFiles()))
        return out

    monkeypatch.setattr(lexical, "stage", noted)
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        assert {tuple(r) for r in lexical.search(d, q).collect()} == plain_search(docs, items)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert files["lexical_asked"] == 1


def test_lexical_texts_are_read_once(spark):
    """The totals come from the written postings, not from another pass over the texts."""
    docs, items = search_rows(np.random.default_rng(5))
    d, q = frame(spark, docs, items)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    assert {tuple(r) for r in lexical.search(d.mapInPandas(counted, DOCS), q).collect()} == plain_search(docs, items)
    assert read.value == len(docs)


def test_lexical_search_of_empty_tables(spark):
    d, q = frame(spark, [], [(1, "alpha")])
    assert lexical.search(d, q).count() == 0
    d, q = frame(spark, [(1, "alpha")], [])
    assert lexical.search(d, q).count() == 0
    d, q = frame(spark, [(1, None), (2, "")], [(1, "alpha")])
    assert lexical.search(d, q).count() == 0


def lang_rows():
    rng = np.random.default_rng(2)
    alphabets = {"en": "the and of to in is it th he", "fr": "le la les de et un une est que",
                 "de": "der die und das ist nicht ein ich sch", "es": "el la de que y en los se ñ"}
    rows = []
    for i in range(600):
        lang = list(alphabets)[i % 4]
        rows.append((i, " ".join(rng.choice(alphabets[lang].split(), int(rng.integers(3, 40)))), lang))
    rows += [(600, None, "en"), (601, "123 !!! 45", "fr"), (602, "", None), (None, "la de que", "es"), (603, "the " * 30000, "en"),
             (5, rows[5][1], rows[5][2]), (604, "Le LA les", None)]
    return rows


def plain_nb(rows, texts):
    """Naive Bayes from the same buckets, by plain counting."""
    from crmfunnel.llm import langid
    size = 1 << langid.BITS
    train = [(t, lang) for i, t, lang in rows if i is not None and lang is not None and t is not None
             and zlib.crc32(str(i).encode()) % 5 != 0]
    langs = sorted({lang for _, lang in train})
    counts = {lang: np.zeros(size) for lang in langs}
    docs = dict.fromkeys(langs, 0)
    for t, lang in train:
        np.add.at(counts[lang], langid.grams(t), 1)
        docs[lang] += 1
    out = []
    for t in texts:
        if t is None or not re.search(r"[^\W\d_]", t):
            out.append(("und", 0.0))
            continue
        h = langid.grams(t)
        s = np.array([math.log(docs[lg] / len(train)) + np.log((counts[lg][h] + langid.ALPHA) / (counts[lg].sum() + langid.ALPHA * size)).sum()
                      for lg in langs])
        p = np.exp(s - s.max())
        out.append((langs[int(s.argmax())], float(p.max() / p.sum())))
    return out


def test_language_id_is_naive_bayes(spark):
    from crmfunnel.llm import langid
    rows = lang_rows()
    df = spark.createDataFrame([(i, t, lg, "src", 1) for i, t, lg in rows], "doc_id long, text string, lang string, source string, held_out int")
    got = {(r["doc_id"], r["held_out"]): r for r in langid.identify(df.repartition(3)).collect()}
    assert len(got) == len(rows) - 1  # the repeated row is one key here
    want = plain_nb(rows, [t for _, t, _ in rows])
    for (i, t, _), (lang, score) in zip(rows, want, strict=True):
        held = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        r = got[(i, held)]
        assert r["lang_pred"] == lang
        assert r["score"] == pytest.approx(score, abs=1e-3)
    held = [(got[(i, True)]["lang_pred"], lg) for i, t, lg in rows[:600] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) >= 0.95
    for i in (600, 601):
        assert got[(i, zlib.crc32(str(i).encode()) % 5 == 0)]["lang_pred"] == "und"


def test_language_id_blocks_count_each_gram_once(monkeypatch):
    from crmfunnel.llm import langid
    text = "abcdefghij" * 7 + "é"
    whole = np.sort(langid.grams(text))
    monkeypatch.setattr(langid, "BLOCK", 8)
    assert np.array_equal(np.sort(langid.grams(text)), whole)
    assert len(whole) == 3 * len(text) + 3


def test_language_id_without_training_rows_or_rows(spark):
    from crmfunnel.llm import langid
    df = spark.createDataFrame([(0, "hello there", None), (1, None, "en")], "doc_id long, text string, lang string")
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in (0, 1)]
    assert [tuple(r) for r in langid.identify(df).orderBy("doc_id").collect()] == [(0, held[0], "und", 0.0), (1, held[1], "und", 0.0)]
    assert langid.identify(df.limit(0)).count() == 0


def plain_codes(rows):
    """The contract of op12 by plain k-means: rows are (vec_id, vector, label)."""
    import hashlib
    good = [(i, v, lab) for i, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not good:
        return set()
    ints = [(i, np.floor(1024 * np.array(v, np.float64)).astype(np.int64), lab) for i, v, lab in good]
    ints.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, tuple(r[1])))
    d = len(ints[0][1])
    ints = [r for r in ints if len(r[1]) == d]
    cut = [(j * d // 4, (j + 1) * d // 4) for j in range(4)]
    data = [np.array([r[1][a:b] for r in ints], np.int64).reshape(len(ints), b - a) for a, b in cut]
    books = [x[:256].copy() for x in data]

    def nearest(x, book):
        dist = ((x[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        return dist.argmin(axis=1), dist.min(axis=1)

    for _ in range(4):
        for j in range(4):
            entry, _ = nearest(data[j], books[j])
            for e in np.unique(entry):
                books[j][e] = np.floor_divide(data[j][entry == e].sum(axis=0), (entry == e).sum())
    found = [nearest(data[j], books[j]) for j in range(4)]
    digest = hashlib.sha256(",".join(str(int(c)) for b in books for c in b.ravel()).encode()).hexdigest()
    error = sum(f[1] for f in found)
    by_label = {}
    for r, e in zip(ints, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    return {(r[0], "".join(f"{int(found[j][0][n]):02x}" for j in range(4)), int(error[n]), by_label[r[2]], digest)
            for n, r in enumerate(ints)}


def code_rows(rng, n=700, d=8):
    centers = rng.normal(size=(5, d))
    rows = [(int(i), (centers[i % 5] + 0.1 * rng.normal(size=d)).astype(np.float32).tolist(), int(i % 3) if i % 7 else None)
            for i in range(n)]
    rows += [(n, None, 1), (n + 1, [float("nan")] * d, 1), (n + 2, [1.0] * (d - 1) + [None], 2), (n + 3, [1.0] * 3, 2),
             (None, [0.5] * d, 1), (n + 4, [float("-inf")] + [0.0] * (d - 1), 0), (n + 5, [0.0] * d, 1)]
    rows += [(n + 6 + i, rows[11][1], 2) for i in range(300)] + [rows[3], rows[3]]
    return rows


def test_vector_codes_are_plain_k_means(spark, monkeypatch):
    from crmfunnel.llm import vcodes
    monkeypatch.setattr(vcodes, "BLOCK", 16)
    rows = code_rows(np.random.default_rng(4))
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], "vec_id long, embedding array<float>, label int, code string")
    got = [tuple(r) for r in vcodes.encode(df.repartition(4)).collect()]
    want = plain_codes([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows])
    # two more copies of row 3 give equal rows
    assert set(got) == want and len(got) == len(want) + 2
    assert vcodes.encode(df.limit(0)).count() == 0


def test_vector_codes_with_few_rows_and_a_shortlist(spark):
    from crmfunnel.llm import vcodes
    rows = [(i, [float(i % 4), float(i % 3), 0.5, -0.25], None) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert {tuple(r) for r in vcodes.encode(df).collect()} == plain_codes(rows)
    lo, hi = np.array([0, 0]), np.array([1, 1])
    book = np.array([[0, 0], [10, 10], [1, 1], [-20, 0]])
    assert list(vcodes._shortlist(lo, hi, book)) == [0, 2]
