"""Chat formatting: least-cost repair of roles by dynamic programming over an automaton of legal turns.

A legal conversation has at most one system turn, first; then user and assistant take turns,
beginning with the user and ending with the assistant.  For each turn of the input the repair may

* keep it, or relabel it (cost 3), as the next turn;
* merge it into the turn before (cost 1 for the same role, 4 for another one);
* first insert empty turns (cost 2 each).

The cheapest sequence of such steps is found exactly and rendered as
``<|role|>\\n text <|end|>\\n``; merged texts are joined by a line feed, and ``<|`` inside a text
becomes ``< |``.

A turn acts on costs as a small matrix over the automaton's states, in the (min, +) sense, so a
long conversation is cut into segments of bounded length: the product of a segment's matrices needs
only its roles, a scan over a conversation's segments fixes the states at their ends, and each
segment is then traced and rendered by itself, as one ``part`` of the conversation.

Defined results: other or missing roles are relabelled or merged; a missing text is empty; a turn
without a conversation id is a conversation of its own; turns without a number come first, and ties
in number go by role and text; repeated rows are turns like any other; an empty table gives no rows.
The rows of one (conversation, turn number) are held together.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lazily, stage

RELABEL, MERGE, INSERT = 3, 1, 2
#: Turn numbers that one segment spans.
SEGMENT = 1024
ROLES = ("system", "user", "assistant")
OTHER = len(ROLES)
#: States: at the start, after a system, a user, an assistant turn.  Moves: state -> role -> state.
START, DONE, STATES = 0, 3, 4
LEGAL = {0: {0: 1, 1: 2}, 1: {1: 2}, 2: {2: 3}, 3: {1: 2}}
_LAST = {1: 0, 2: 1, 3: 2}


def _insertions() -> dict[tuple[int, int], tuple[int, ...]]:
    """Shortest lists of roles that lead from a state to another."""
    paths = {(s, s): () for s in range(STATES)}
    for length in range(1, STATES):
        for roles in itertools.product(range(OTHER), repeat=length):
            for s in range(STATES):
                t = s
                for r in roles:
                    t = LEGAL[t].get(r, -1) if t >= 0 else -1
                if t >= 0:
                    paths.setdefault((s, t), roles)
    return paths


INSERTIONS = _insertions()


def _steps(role: int) -> dict[tuple[int, int], tuple[int, tuple[int, ...], str, int]]:
    """Cheapest (cost, inserted roles, action, role) of a turn from state to state; ties to fewer insertions."""
    best: dict = {}
    for (s, mid), inserted in INSERTIONS.items():
        options = [((0 if r == role else RELABEL), "keep" if r == role else "relabel", r, t) for r, t in LEGAL[mid].items()]
        if mid != START:
            options.append((MERGE if _LAST[mid] == role else MERGE + RELABEL, "merge", _LAST[mid], mid))
        for cost, action, r, t in options:
            new = (cost + INSERT * len(inserted), inserted, action, r)
            old = best.get((s, t))
            if old is None or (new[0], len(new[1]), new[2]) < (old[0], len(old[1]), old[2]):
                best[s, t] = new
    return best


STEPS = [_steps(r) for r in range(OTHER + 1)]


def _matrix(costs: dict) -> np.ndarray:
    m = np.full((STATES, STATES), np.inf)
    for (s, t), c in costs.items():
        m[s, t] = c
    return m


MATRICES = [_matrix({k: v[0] for k, v in steps.items()}) for steps in STEPS]
FINISH = _matrix({k: INSERT * len(v) for k, v in INSERTIONS.items()})[:, DONE]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None]).min(1)


def product_of(roles: list[int]) -> np.ndarray:
    out = np.where(np.eye(STATES) > 0, 0.0, np.inf)
    for r in roles:
        out = times(out, MATRICES[r])
    return out


def trace(roles: list[int], entry: int, leave: int) -> list[tuple[int, tuple[int, ...], str, int]]:
    """The cheapest step of each turn on the way from ``entry`` to ``leave``."""
    costs = [np.where(np.arange(STATES) == entry, 0.0, np.inf)]
    for r in roles:
        costs.append((costs[-1][:, None] + MATRICES[r]).min(0))
    out, t = [], leave
    for i in range(len(roles) - 1, -1, -1):
        s = int((costs[i] + MATRICES[roles[i]][:, t]).argmin())
        out.append(STEPS[roles[i]][s, t])
        t = s
    return out[::-1]


def render(texts: list[str], steps: list, entry: int, last: bool, leave: int) -> dict:
    """Text and counts of a segment; an open turn is closed when the next one opens or the conversation ends."""
    out: list[str] = []
    is_open = entry != START
    counts = {"merged": 0, "relabelled": 0, "inserted": 0}

    def begin(role: int, text: str) -> None:
        nonlocal is_open
        out.append(("<|end|>\n" if is_open else "") + f"<|{ROLES[role]}|>\n{text}")
        is_open = True

    for text, (_, inserted, action, role) in zip(texts, steps, strict=True):
        for r in inserted:
            begin(r, "")
        safe = text.replace("<|", "< |")
        if action == "merge":
            out.append("\n" + safe)
        else:
            begin(role, safe)
        counts["inserted"] += len(inserted)
        counts["merged"] += action == "merge"
        counts["relabelled"] += action == "relabel"
    if last:
        for r in INSERTIONS[leave, DONE]:
            begin(r, "")
            counts["inserted"] += 1
        out.append("<|end|>\n" if is_open else "")
    return {"rendered": "".join(out), **counts}


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[dict[str, list]]:
    """Runs of equal keys of sorted rows, also across batches, as lists by column."""
    held: dict[str, list] | None = None
    for pdf in batches:
        columns = {c: pdf[c].tolist() for c in pdf.columns}
        if held is not None:
            columns = {c: held[c] + columns[c] for c in columns}
        rows = list(zip(*(columns[k] for k in keys), strict=True))
        if not rows:
            continue
        begin = 0
        for i in range(1, len(rows)):
            if rows[i] != rows[i - 1]:
                yield {c: v[begin:i] for c, v in columns.items()}
                begin = i
        held = {c: v[begin:] for c, v in columns.items()}
    if held is not None:
        yield held


_SUMMARY = "conv_id long, segment long, turns int, product array<double>"
_ENDS = "conv_id long, segment long, entry int, leave int, last boolean, cost double"
_PARTS = ("conv_id long, part long, turns int, merged int, relabelled int, inserted int, cost double, rendered string")


@functools.lru_cache(maxsize=65536)
def _short_product(roles: tuple[int, ...]) -> list[float]:
    return product_of(list(roles)).ravel().tolist()


def _summarise(batches):
    for g in _groups(batches, ["conv_id", "segment"]):
        yield (g["conv_id"][0], g["segment"][0], len(g["role"]), _short_product(tuple(g["role"])))


def _ends(batches):
    for g in _groups(batches, ["conv_id"]):
        products = [np.array(p).reshape(STATES, STATES) for p in g["product"]]
        costs = [np.where(np.arange(STATES) == START, 0.0, np.inf)]
        for m in products:
            costs.append((costs[-1][:, None] + m).min(0))
        t = int((costs[-1] + FINISH).argmin())
        out = []
        for i in range(len(products) - 1, -1, -1):
            leave, last = t, i == len(products) - 1
            t = int((costs[i] + products[i][:, leave]).argmin())
            out.append((g["conv_id"][0], g["segment"][i], t, leave, last,
                        float(products[i][t, leave] + (FINISH[leave] if last else 0))))
        yield from out


def _row(texts: list[str], roles: list[int], entry: int, leave: int, last: bool, cost: float, conv_id, segment) -> tuple:
    made = render(texts, trace(roles, entry, leave), entry, last, leave)
    return (conv_id, segment, len(roles), made["merged"], made["relabelled"], made["inserted"], cost, made["rendered"])


def _parts(batches):
    for g in _groups(batches, ["conv_id", "segment"]):
        roles = [int(r) for r in g["role"][1:]]
        yield _row(g["text"][1:], roles, int(g["entry"][0]), int(g["leave"][0]), bool(g["last"][0]), g["cost"][0],
                   g["conv_id"][0], g["segment"][0])


def _alone(batches):
    for pdf in batches:
        for role, text in zip(pdf["role"], pdf["text"], strict=True):
            costs = MATRICES[role][START] + FINISH
            leave = int(costs.argmin())
            yield _row([text], [role], START, leave, True, float(costs[leave]), None, 0)


def _run(batches, fn, columns: list[str], size: int = 4000):
    rows = fn(batches)
    while batch := list(itertools.islice(rows, size)):
        frame = pd.DataFrame(batch, columns=columns)
        yield frame.assign(conv_id=frame["conv_id"].astype("Int64"))


def _with(fn, schema: str) -> tuple:
    columns = [c.split()[0] for c in schema.split(", ")]
    return lazily(_run, fn, columns), schema


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """``conv_id, part, turns, merged, relabelled, inserted, cost, rendered``: one row for each segment of a conversation."""
    role = F.lower(F.trim(F.col(f"`{role_col}`")))
    code = F.lit(OTHER)
    for i, name in enumerate(ROLES):
        code = F.when(role == name, i).otherwise(code)
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        code.cast("int").alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # turns without a number go before all others, in an order of their own that spreads them over segments
    unnumbered = F.pmod(F.xxhash64("role", "text"), F.lit(1 << 20)) - (1 << 60)
    rows = rows.withColumn("segment", F.coalesce(F.floor(F.col("turn") / segment), unnumbered))
    known = rows.filter(F.col("conv_id").isNotNull())
    order = ["conv_id", "segment", "turn", "role"]
    tie = F.xxhash64("text")
    summary = (known.withColumn("tie", tie).drop("text").repartition("conv_id", "segment")
               .sortWithinPartitions(*order, "tie").mapInPandas(*_with(_summarise, _SUMMARY)))
    # a fixed number of tasks: these rows are few bytes but not little work
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = stage(summary.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "segment")
                 .mapInPandas(*_with(_ends, _ENDS)), "ends")
    # the states at a segment's ends come as a row before its turns: one shuffle brings both together
    states = ends.select("conv_id", "segment", F.lit(0).alias("follows"), "entry", "leave", "last", "cost")
    parts = (known.select("*", tie.alias("tie"), F.lit(1).alias("follows")).unionByName(states, allowMissingColumns=True)
             .repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "follows", "turn", "role", "tie")
             .mapInPandas(*_with(_parts, _PARTS)))
    alone = rows.filter(F.col("conv_id").isNull()).mapInPandas(*_with(_alone, _PARTS))
    return parts.unionByName(alone)
