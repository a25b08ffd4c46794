"""Operators on vectors, conversations and pages, the registered queries and the pipeline."""

from __future__ import annotations

import heapq
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from crmfunnel.llm import ann, chat, quality, secret_scan, topk, warc
from crmfunnel.llm.common import small_batches
from crmfunnel.llm.queries import ORACLE_SQL, QUERIES
from crmfunnel.verify.compare import connect, difference

from test_llm_documents import WORD, classes, targets

DATA = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, score double, rank int, b long, norm double"


def vector_rows():
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=6).tolist()) for i in range(300)]
    rows += [(1000, [0.0] * 6), (1050, None), (1100, [float("nan")] * 6), (1150, [float("inf")] * 6), (1200, []), (1250, [1.0, None] * 3),
             (1300, [1.0, 2.0]), (None, [1.0] * 6), (1301, [2.0, 4.0])]
    rows += [(2000 + i, rows[50][1]) for i in range(8)] + [rows[7], rows[7], (9, [5.0] * 6)]
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], 0.0, 1, 2, 3.0) for i, v in rows]


def usable(rows):
    return [(i, np.array(v)) for i, v, *_ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]


def best_by(rows, k, step, score):
    out = set()
    for q in {i for i, _ in rows if i % step == 0}:
        found = {}
        for i, a in rows:
            for j, b in rows:
                if i == q and j != q and len(a) == len(b):
                    found[j] = max(found.get(j, -np.inf), score(a, b))
        for rank, (s, j) in enumerate(sorted((-s, j) for j, s in found.items())[:k], 1):
            out.add((q, rank, j, -s))
    return out


def test_top_products(spark):
    df = spark.createDataFrame(vector_rows(), VECTORS).repartition(3)
    rows = [(i, np.floor(1024 * v).astype("i8")) for i, v in usable(vector_rows())]
    want = best_by(rows, 10, 100, lambda a, b: int(a @ b))
    assert {tuple(r) for r in topk.top_products(df, 10, 100).collect()} == want
    assert topk.top_products(spark.createDataFrame([], VECTORS), 10, 100).count() == 0


def test_top_products_of_uneven_and_huge_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=5) * 10.0 ** (i % 6)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want = best_by(exact, 10, 100, lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)))
    assert {tuple(r) for r in topk.top_products(df, 10, 100).collect()} == want
    far = spark.createDataFrame([(0, [1e300]), (100, [1e300]), (200, [-1e300])], "vec_id long, embedding array<double>")
    assert {(r.query_id, r.vec_id, r.score) for r in topk.top_products(far, 1, 100).collect()} == {
        (0, 100, 2 ** 63 - 1), (100, 0, 2 ** 63 - 1), (200, 0, -2 ** 63)}


def test_nearest(spark):
    df = spark.createDataFrame(vector_rows(), VECTORS).repartition(3)
    rows = [(i, v) for i, v in usable(vector_rows()) if v.any()]
    want = best_by(rows, 5, 50, lambda a, b: float((a * b).sum() / np.sqrt((a ** 2).sum() * (b ** 2).sum())))
    least = {}
    for q, _, _, s in want:
        least[q] = min(least.get(q, 2), s)
    found = ann.nearest(df, 5, 50, shard=100).collect()
    assert {(r.query_id, r["rank"]) for r in found} == {w[:2] for w in want}
    assert sum(r.score >= least[r.query_id] - 1e-9 for r in found) >= 0.9 * len(want)
    assert ann.nearest(spark.createDataFrame([], VECTORS), 5, 50).count() == 0


def test_nearest_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.collect()
    ids = np.array([r.vec_id for r in rows])
    points = np.array([r.embedding for r in rows], "f8")
    points /= np.linalg.norm(points, axis=1)[:, None]
    asked = np.flatnonzero(ids % 50 == 0)
    cos = points[asked] @ points.T
    cos[np.arange(len(asked)), asked] = -2
    kth = dict(zip(ids[asked].tolist(), np.sort(cos, 1)[:, -5].tolist(), strict=True))
    found = ann.nearest(vectors, 5, 50, shard=700).collect()
    assert len(found) == 5 * len(asked) and sum(r.score >= kth[r.query_id] - 1e-9 for r in found) >= 0.9 * len(found)


def cheapest(roles):
    """Least cost by exploring repairs one move at a time."""
    queue, done = [(0, 0, 0)], set()
    while queue:
        cost, i, state = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(roles) and state == 3:
            return cost
        for role, after in chat.LEGAL[state].items():
            heapq.heappush(queue, (cost + 2, i, after))
            if i < len(roles):
                heapq.heappush(queue, (cost + (0 if roles[i] == role else 3), i + 1, after))
        if i < len(roles) and state:
            same = {1: "system", 2: "user", 3: "assistant"}[state] == ("system", "user", "assistant", "")[roles[i]]
            heapq.heappush(queue, (cost + (1 if same else 4), i + 1, state))
    return None


def test_chat_repair_is_cheapest_and_legal(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(60):
        rows += [(conv, t, rng.choice(["user", "assistant", "system", "User ", None, "tool"]), rng.choice(["hi <|", "", None, "x"]), 1, 2)
                 for t in range(rng.randint(1, 9))]
    rows += [(None, 1, "user", "alone", 1, 1), (None, None, None, None, 1, 1), (70, None, "user", "a", 1, 1), (70, None, "user", "a", 1, 1), (70, 0, "assistant", "b", 1, 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int, segment int").repartition(3)
    whole, cut = chat.repair(df).collect(), chat.repair(df, segment=2).collect()
    codes = {"system": 0, "user": 1, "assistant": 2}
    for conv in range(60):
        roles = [codes.get((r[2] or "").strip().lower(), 3) for r in rows if r[0] == conv]
        (one,) = [r for r in whole if r.conv_id == conv]
        parts = sorted((r for r in cut if r.conv_id == conv), key=lambda r: r.part)
        assert one.cost == cheapest(roles) == sum(r.cost for r in parts) and one.turns == len(roles)
        for text in (one.rendered, "".join(r.rendered for r in parts)):
            assert re.fullmatch(r"(<\|system\|>\n[^|]*<\|end\|>\n)?(<\|user\|>\n[^|]*<\|end\|>\n<\|assistant\|>\n[^|]*<\|end\|>\n)+",
                                text.replace("< |", "<"))
    assert sum(r.turns for r in whole) == len(rows) and len([r for r in whole if r.conv_id is None]) == 2
    assert chat.repair(df.limit(0)).count() == 0


def test_audit_finds_what_replicas_do_not_share(spark):
    rows = [(i, f"http://h/{i}", "é" * (i % 50)) for i in range(500)] + [(None, None, None), (3, "http://h/3", "éé")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, archive string, offset long").repartition(3)
    a = warc.records(pages, limit=20_000)
    assert a.count() == 502 and a.groupBy("archive").agg(F.max(F.col("offset") + F.col("length")).alias("m")).agg(F.max("m")).first()[0] <= 20_000
    b = a.filter("coalesce(record_id, 0) <> 10").withColumn("record", F.when(F.col("record_id") == 20, F.lit(b"x")).otherwise(F.col("record")))
    found = warc.audit(a.filter("coalesce(record_id, 0) <> 30"), b, span=1000, fanout=4)
    assert {(r.record_id, r.kind) for r in found.collect()} == {(10, "lost"), (20, "changed"), (30, "added")}
    assert warc.audit(a, a).count() == 0 and warc.audit(a.limit(0), a.limit(0)).count() == 0
    one = a.filter("record_id = 7").first()
    head, _, body = bytes(one.record).partition(b"\r\n\r\n")
    assert body == ("é" * 7).encode() + b"\r\n\r\n" and b"Content-Length: 14" in head and one.length == len(one.record)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_queries_against_sql(spark, key):
    assert difference(QUERIES[key](spark, DATA), connect(DATA), ORACLE_SQL[key]) is None


def test_all_ten_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {f"op{i}_" for i in range(1, 11)} <= {re.match(r"(op\d+_)?", n).group() for n in names} and "pipeline" in names


def test_pipeline_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]

    good = steps["quality classifier"](spark, docs, DATA)
    model = quality.train(quality.describe(docs), spark.read.parquet(f"{DATA}/labels.parquet"))
    scores = model.score(np.array([quality.statistics(t) for _, t, _ in rows]))
    rows = [r for r, s in zip(rows, scores, strict=True) if s >= 0.3]
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == {r[0] for r in rows}

    single = steps["n-gram Jaccard join"](spark, good, DATA)
    named = {d for d, _, c in classes([r[:2] for r in rows]) if d == c}
    rows = [r for r in rows if r[0] in named]
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(named)

    clean = steps["secret scans"](spark, single, DATA)
    rows = [(d, secret_scan.masked(t, secret_scan.spans_of(t)), s) for d, t, s in rows]
    assert {(r.doc_id, r.text, r.source) for r in clean.collect()} == set(rows)
    assert clean.filter("n_chars <> length(text)").count() == 0

    mixed = steps["mixing sources"](spark, clean, DATA)
    sizes, taken = {}, {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text))
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(WORD.findall(r.text))
    assert mixed.columns == docs.columns
    assert all(abs(taken[s] - goal) < 1 for s, goal in targets(sizes).items())

    packed = steps["best-fit packing"](spark, mixed, DATA)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
    assert packed.agg(F.sum("length")).first() == corpus_pipeline.run(spark, DATA).agg(F.sum("length")).first()


def test_pipeline_stages_on_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, gone long"
    odd = [(1, "a b c d e", "en", "s", 9, 0.1, 1), (2, "a b c d e", "en", None, None, None, None), (None, None, None, None, None, None, None),
           (3, "", "en", "s", 0, 0.0, 0), (1, "a b c d e", "en", "s", 9, 0.1, 1), (4, "w " * 30_000, None, "t", 1, 1.0, 1)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, step in corpus_pipeline.STAGES[:-1]:
            docs = step(spark, docs, str(tmp_path))
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert (packed.count() > 0) == bool(rows)


def test_queries_of_a_block_share_one_product(monkeypatch):
    rng = np.random.default_rng(7)
    vecs, asked = rng.integers(-900, 900, (400, 8)), rng.integers(-900, 900, (40, 8))
    vecs = vecs[np.argsort(-(vecs ** 2).sum(1))]
    row = {"ids": np.arange(400).tobytes(), "vecs": vecs.tobytes(), "dim": 8, "q_ids": np.arange(40).tobytes(),
           "q_vecs": asked.tobytes(), "q_bounds": np.full(40, 1000.0).tobytes()}
    calls, plain = [], topk._products
    monkeypatch.setattr(topk, "_products", lambda *a: calls.append(1) or plain(*a))
    got = pd.concat(topk._search(iter([pd.DataFrame([row])]), 3))
    assert len(calls) < 20
    scores = asked @ vecs.T
    for q in range(40):
        best = sorted(((-int(scores[q, i]), i) for i in range(400) if i != q and scores[q, i] >= 1000))[:3]
        assert sorted(zip(-got[got.query_id == q].score, got[got.query_id == q].vec_id)) == best


def test_batches_of_long_texts_are_bounded_in_bytes(spark):
    def sizes_of(batches):
        for pdf in batches:
            yield pd.DataFrame({"size": [int(pdf["text"].str.len().sum())]})

    texts = spark.range(0, 60, numPartitions=1).select(F.expr("repeat('0123456789abcdef', 40000 + int(id))").alias("text"))
    got = small_batches(texts).mapInPandas(sizes_of, "size long").agg(F.max("size"), F.sum("size")).first()
    assert got[0] < 16_000_000 and got[1] == sum(16 * (40000 + i) for i in range(60))


def test_batches_of_long_texts_are_a_few_mb_and_few_rows_are_read_at_once(spark, tmp_path):
    def sizes_of(batches):
        for pdf in batches:
            yield pd.DataFrame({"size": [int(pdf["text"].str.len().sum())], "many": [len(pdf)]})

    texts = spark.range(0, 60, numPartitions=1).select(F.expr("repeat('0123456789abcdef', 40000 + int(id))").alias("text"))
    texts.write.parquet(str(tmp_path / "texts"))
    got = small_batches(spark.read.parquet(str(tmp_path / "texts"))).mapInPandas(sizes_of, "size long, many long").agg(
        F.max("size"), F.sum("size"), F.sum("many")).first()
    assert got[0] < 3_000_000 and got[1] == sum(16 * (40000 + i) for i in range(60)) and got[2] == 60
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512


def test_pairs_of_blocks_are_never_sent_to_the_driver(spark):
    from crmfunnel.llm import vectors
    data = b"\0" * 512
    blocks = spark.range(40).selectExpr("id as b", "2 as dim", "1 as n", "1.0D as top", "binary('x') as ids", "binary('y') as vecs")
    queries = spark.createDataFrame([(q, 2, 1, 1.0, data, data) for q in range(20)],
                                    "q long, dim int, n int, top double, ids binary, vecs binary")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
        met = vectors.pairs(queries, blocks, 40)
        assert met.select("q", "b").distinct().count() == met.count() == 800
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_task_gives_its_freed_memory_back():
    from pathlib import Path

    from crmfunnel.llm.common import lazily
    pins = []

    def resident():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    def work(batches):
        for b in batches:
            blocks = [np.ones(1000) for _ in range(20_000)]  # 160 MB of the heap, under a block that stays
            pins.append(np.ones(1000))
            yield b + len(blocks)

    before = resident()
    assert list(lazily(work)(iter([1, 2]))) == [20_001, 20_002]
    assert resident() - before < 80
