"""Secret scans: one minimised automaton for all rules, walked once over the bytes of a text.

Method.  The rules' regular expressions are compiled together by subset construction and
minimised into transition arrays.  The combined automaton reads a text backwards in one pass
and marks at each byte the rules of which a match begins there.  From the first mark at or
after the end of a rule's last match, the rule's own automaton extends the match as far as it
goes, so matches are leftmost, longest and do not overlap within a rule.

Defined results: a null or empty text has no span; a null id stays a row; repeated rows give
repeated rows; other columns of the input are not read.  Offsets count code points.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import compile_rules, dead_states, rows_of
from .common import give_back, lazily, small_batches, text_of


@dataclass(frozen=True)
class Rule:
    """``least``: drop shorter matches; with ``tail``, matches whose value of these bytes is shorter.

    Least lengths are checked on the match, not counted by the automaton: counters of several
    rules would multiply its states.
    """

    kind: str
    pattern: str
    fold: bool = False
    tail: str = ""
    least: int = 0


_VALUE = "A-Za-z0-9+/_.=-"
#: The base rules.  Runs of hexadecimal digits below 8 are left out by the automaton, those
#: below 32 by their length.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", True,
         _VALUE, 8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{8,}", least=32),
)
#: Further rules of public key formats.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("url_login", r"[a-z]+://[A-Za-z0-9._-]+:[A-Za-z0-9._%+-]+@"),
)
RULES = BASE + MORE
SPANS = "array<struct<kind:string,start:long,end:long>>"


@functools.lru_cache(maxsize=8)
def _compiled(rules: tuple[Rule, ...]):
    combined, anchored = compile_rules([(r.pattern, r.fold) for r in rules])
    if max(combined.accepts) >= 1 << 62:
        raise ValueError("at most 62 rules in one automaton")
    return rows_of(combined), [(a, dead_states(a)) for a in anchored], len(combined.next)


def states(rules: tuple[Rule, ...] = RULES) -> int:
    """Size of the minimised combined automaton."""
    return _compiled(rules)[2]


def _longest(automaton, dead: set[int], data: bytes, at: int) -> int:
    state, end = 0, -1
    for i in range(at, len(data)):
        state = automaton.next[state][data[i]]
        if state in dead:
            break
        if automaton.accepts[state]:
            end = i + 1
    return end


_mask = itemgetter(256)


def spans_of(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) by start, then in the order of the rules."""
    start, anchored, _ = _compiled(rules)
    data = text.encode("utf-8", "surrogatepass")
    size = len(data)
    walk = map(_mask, accumulate(reversed(data), getitem, initial=start))
    next(walk)
    marks = np.frombuffer(bytes(walk), "u1") if len(rules) <= 8 else np.fromiter(walk, "i8", size)
    begins = np.flatnonzero(marks)[::-1]
    if not len(begins):
        return []
    bits = marks[begins]
    begins = size - 1 - begins
    found: list[tuple[int, int, int]] = []
    for r, rule in enumerate(rules):
        mine = begins[(bits >> r) & 1 == 1]
        i = 0
        while i < len(mine):
            at = int(mine[i])
            end = _longest(*anchored[r], data, at)
            if (_tail(data[at:end], rule.tail) if rule.tail else end - at) >= rule.least:
                found.append((at, r, end))
            i = int(np.searchsorted(mine, end))
    if size != len(text):
        firsts = np.concatenate([[0], np.cumsum((np.frombuffer(data, "u1") & 0xC0) != 0x80)])
        found = [(int(firsts[a]), r, int(firsts[e])) for a, r, e in found]
    return [(rules[r].kind, a, e) for a, r, e in sorted(found)]


@functools.lru_cache(maxsize=64)
def _members(spec: str) -> frozenset[int]:
    from .automaton import _Parser

    return _Parser(f"[{spec}]", False).parse()[1][0][1]


def _tail(match: bytes, spec: str) -> int:
    """Length of the value at the end of a match: its bytes after the last separator.

    The value is taken greedily after the first ``:`` or ``=`` (and blanks and a quote), so it may
    hold further ``=``.
    """
    cut = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[cut + 1:].lstrip(b" ")
    if value[:1] in (b'"', b"'"):
        value = value[1:]
    members = _members(spec)
    return sum(b in members for b in value)


def _scan(batches: Iterator[pd.DataFrame], rules: tuple[Rule, ...]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        spans = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t, rules)] for t in pdf["text"]]
        yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "spans": pd.Series(spans, dtype=object)})


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row; the scan needs no shuffle."""
    return text_of(docs, id_col, text_col).mapInPandas(lazily(_scan, rules), f"doc_id long, spans {SPANS}")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first."""
    out, at, done = [], 0, -1
    for kind, start, end in spans:
        if start >= done:
            out += [text[at:start], f"[{kind}]"]
        done = at = max(done, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All rows with all columns; secrets in the text are masked, and its length in ``length_col`` is kept up."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        # null where nothing was found: such texts don't travel back
        found = [spans_of(t, rules) for t in texts]
        give_back()
        return pd.Series([masked(t, s) if s else None for t, s in zip(texts, found, strict=True)], dtype=object)

    text = F.col(f"`{text_col}`")
    fresh = "__masked"
    while fresh in docs.columns:
        fresh += "_"
    out = small_batches(docs).withColumn(fresh, clean(F.coalesce(text, F.lit(""))))
    if length_col:
        out = out.withColumn(length_col, F.when(F.col(fresh).isNotNull(), F.length(fresh).cast(docs.schema[length_col].dataType))
                             .otherwise(F.col(f"`{length_col}`")))
    return out.withColumn(text_col, F.coalesce(F.col(fresh), text)).drop(fresh)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Counts of the base kinds and the digest of their spans."""
    kinds = [r.kind for r in base]
    own = F.filter("spans", lambda s: s["kind"].isin(kinds))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select("doc_id", *[count(k) for k in kinds], F.sha2(_joined(own), 256).alias("base_sha256"),
                          _joined(F.col("spans")).alias("spans"))
