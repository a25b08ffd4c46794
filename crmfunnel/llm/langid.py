"""Language identification: multinomial naive Bayes over hashed character n-grams.

Method.  A text is lower-cased and framed by one space; its characters' 1-, 2- and 3-grams are hashed into
``2**BITS`` buckets.  Fitting counts, per language, the n-grams of every training text in the tasks that
read them (one dense vector of counts per language and task, sent as its non-zero buckets) and sums them in
one aggregation by (language, bucket); the driver receives at most languages x buckets sums and turns them
into a matrix of Laplace-smoothed log-probabilities (float32, ``2**BITS * 4`` bytes a language, checked
against ``MAX_MODEL_BYTES`` before it is broadcast).  Scoring hashes a batch of texts into one sparse list
of (text, bucket) and sums the matrix's columns per text with ``bincount``: the batch's count matrix times
the log-probabilities, without a dense matrix of texts.  The score is the posterior of the chosen language.

A text is hashed in blocks of ``BLOCK`` characters that overlap by two, so that a long text needs memory of
a block, and every n-gram is counted once.

Learning uses every row whose ``crc32(doc_id as text) mod 5`` is not 0 and whose language and text are not
null; language, source and id are never inputs of a prediction.

Defined results: a null text, or one without a letter (Unicode category L), is ``und`` with score 0; without
any training row every prediction is ``und`` with score 0; a null id is never learned from and is not held
out; rows that repeat an id are scored each, and each is learned from; equal posteriors go to the language
first in code-point order; an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lazily

#: Buckets of hashed n-grams, longest n-gram, smoothing and the largest model that is broadcast.
BITS = 18
LONGEST = 3
ALPHA = 0.1
MAX_MODEL_BYTES = 256 << 20
#: Characters hashed at once; grams a batch scores at once.
BLOCK = 1 << 20
GRAMS = 1 << 22
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = (np.uint64(0x100000001B3), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def grams(text: str, bits: int = BITS) -> np.ndarray:
    """Buckets of all 1- to ``LONGEST``-grams of the framed, lower-cased text, block by block."""
    framed = f" {text.lower()} "
    out = []
    for start in range(0, len(framed), BLOCK):
        piece = framed[start:start + BLOCK + LONGEST - 1]
        own = min(BLOCK, len(framed) - start)
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        h = np.zeros(len(codes), np.uint64)
        with np.errstate(over="ignore"):
            for n in range(1, LONGEST + 1):
                if len(codes) < n:
                    break
                h = h[: len(codes) - n + 1] * _STEP[0] + codes[n - 1:] * _STEP[n - 1]
                key = h[:own] ^ np.uint64(n)
                key = (key ^ (key >> np.uint64(29))) * _MIX
                out.append((key >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _count(batches: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    """Counts of one task, per language, as its non-zero buckets."""
    size = 1 << bits
    counts: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            h = grams(text, bits)
            if lang not in counts:
                counts[lang] = np.zeros(size, np.int64)
                texts[lang] = 0
            counts[lang] += np.bincount(h, minlength=size)
            texts[lang] += 1
    for lang, c in counts.items():
        nz = np.flatnonzero(c)
        yield pd.DataFrame({"lang": lang, "bucket": np.concatenate([[-1], nz]).astype(np.int64),
                            "count": np.concatenate([[texts[lang]], c[nz]]).astype(np.int64)})


def fit(docs: DataFrame, *, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """Languages in code-point order, their log-priors and the (languages x buckets) log-probabilities."""
    train = (docs.filter(F.col(f"`{id_col}`").isNotNull() & ~held_out(F.col(f"`{id_col}`"))
                         & F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
             .select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")))
    size = 1 << bits
    # the model's size is known before any text is read
    most = MAX_MODEL_BYTES // (size * 4)
    languages = sorted(r["lang"] for r in train.select("lang").distinct().limit(most + 1).collect())
    if len(languages) > most:
        raise ValueError(f"over {most} languages of {size} buckets exceed {MAX_MODEL_BYTES} bytes")
    table = (train.mapInPandas(lazily(_count, bits), "lang string, bucket long, count long")
             .groupBy("lang", "bucket").agg(F.sum("count").alias("count"))).toPandas()
    index = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(languages), size), np.float64)
    texts = np.zeros(len(languages), np.float64)
    for lang, part in table.groupby("lang"):
        own = part["bucket"].to_numpy()
        texts[index[lang]] = part["count"].to_numpy()[own == -1].sum()
        keep = own >= 0
        counts[index[lang], own[keep]] = part["count"].to_numpy()[keep]
    logp = np.log((counts + ALPHA) / (counts.sum(axis=1, keepdims=True) + ALPHA * size)).astype(np.float32)
    prior = np.log(texts / texts.sum()) if len(languages) else texts
    return languages, prior, logp


def _score(batches: Iterator[pd.DataFrame], model, bits: int) -> Iterator[pd.DataFrame]:
    languages, prior, logp = model.value
    for batch in batches:
        n = len(batch)
        pred = np.full(n, UNKNOWN, object)
        score = np.zeros(n)
        usable = np.flatnonzero(batch["letter"].astype("boolean").fillna(False).to_numpy(bool)) if languages else np.zeros(0, int)
        texts = batch["text"].to_numpy(object)
        start = 0
        while start < len(usable):
            rows, parts, total = [], [], 0
            while start < len(usable) and (not rows or total < GRAMS):
                h = grams(texts[usable[start]], bits)
                rows.append(np.full(len(h), len(rows), np.int64))
                parts.append(h)
                total += len(h)
                start += 1
            who, where = np.concatenate(rows), np.concatenate(parts)
            sums = np.stack([np.bincount(who, weights=logp[c, where], minlength=len(parts)) for c in range(len(languages))])
            sums += prior[:, None]
            best = sums.argmax(axis=0)
            post = np.exp(sums - sums.max(axis=0))
            post /= post.sum(axis=0)
            chosen = usable[start - len(parts):start]
            pred[chosen] = np.asarray(languages, object)[best]
            score[chosen] = post[best, np.arange(len(parts))]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": pred, "score": score})


def identify(docs: DataFrame, *, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; the model is learned from the rows that are not held out."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, bits=bits, id_col=id_col, text_col=text_col, lang_col=lang_col))
    doc_id = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{text_col}`").rlike(r"\p{L}").alias("letter"))
    return rows.mapInPandas(lazily(_score, model, bits), "doc_id long, held_out boolean, lang_pred string, score double")
