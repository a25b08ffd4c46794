"""WARC records and their fixity audit by Merkle trees over ordered offset ranges.

Pages are written as WARC records, task by task, into archives of bounded size; a record is known by
its archive and offset.  For the audit of two replicas each record is hashed; hashes of
records in offset order give the digest of a small range, digests of ranges that of a wider
one, up to one root per archive.  Roots of both replicas are compared first, and only the branches
below a mismatch are compared further, down to the records that differ.  As ranges are ranges of
offsets, a lost record changes its own branch and no other.

Defined results: missing parts of a page are empty in its record; a missing page id stays missing;
repeated pages are records of their own; the columns of the input besides id, address and content
are not read.  Records of one (archive, offset) count as one leaf: their number and the least and the
largest digest.  An empty table gives no records, and equal replicas no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lazily, stage

#: Bytes of an archive at most (unless one record is larger), of the narrowest range, and ranges per wider range.
ARCHIVE, SPAN, FANOUT = 64 << 20, 256 << 10, 16
RECORDS = "archive string, offset long, length long, record_id long, record binary"
_NAMESPACE = uuid.UUID(int=0)


def warc_record(url: str, payload: bytes, serial: str) -> bytes:
    """A WARC/1.1 resource record; its id follows from its place and content."""
    digest = hashlib.sha256(payload).hexdigest()
    head = [
        "WARC/1.1", "WARC-Type: resource", f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMESPACE, serial + digest)}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _write(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    task, archive, at = TaskContext.get().partitionId(), 0, 0
    for pdf in batches:
        rows = []
        for record_id, url, html in zip(pdf["record_id"].astype("Int64"), pdf["url"], pdf["html"], strict=True):
            name = f"{task:06d}-{archive:06d}"
            record = warc_record(url, html.encode("utf-8", "surrogatepass"), f"{name}:{at}:")
            if at and at + len(record) > limit:
                archive, at = archive + 1, 0
                name = f"{task:06d}-{archive:06d}"
                record = warc_record(url, html.encode("utf-8", "surrogatepass"), f"{name}:{at}:")
            rows.append((name, at, len(record), record_id, record))
            at += len(record)
        frame = pd.DataFrame(rows, columns=["archive", "offset", "length", "record_id", "record"])
        yield frame.assign(record_id=frame["record_id"].astype("Int64"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            limit: int = ARCHIVE) -> DataFrame:
    """Pages as records, written to the shared folder: places are fixed from then on."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("record_id"),
                        F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url"),
                        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    return stage(rows.mapInPandas(lazily(_write, limit), RECORDS), "records")


def _up(node: Column, width: int) -> Column:
    return F.floor(node / width).cast("long")


def tree(replica: DataFrame, height: int, span: int = SPAN, fanout: int = FANOUT) -> DataFrame:
    """``level, archive, node, digest, record_id`` of all nodes: level 0 are the records by offset, ``height`` the roots."""
    digest = F.sha2(F.col("record"), 256)
    leaves = stage(replica.groupBy("archive", F.col("offset").alias("node")).agg(
        F.count("*").alias("n"), F.min(digest).alias("low"), F.max(digest).alias("high"),
        F.min("record_id").alias("record_id")).select(
        F.lit(0).alias("level"), "archive", "node", F.sha2(F.concat_ws(":", "n", "low", "high"), 256).alias("digest"),
        "record_id"), "leaves")
    levels, below = [leaves], leaves
    for level in range(1, height + 1):
        # a range holds at most ``span`` bytes of records, a wider one ``fanout`` ranges
        children = F.array_sort(F.collect_list(F.struct("node", "digest")))
        below = below.groupBy("archive", _up(F.col("node"), span if level == 1 else fanout).alias("up")).agg(
            F.sha2(F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["node"], c["digest"])), ","), 256)
            .alias("digest")).select(F.lit(level).alias("level"), "archive", F.col("up").alias("node"), "digest",
                                     F.lit(None).cast("long").alias("record_id"))
        levels.append(below)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return stage(out, "tree")


def _mismatches(a: DataFrame, b: DataFrame, level: int, within: DataFrame | None, width: int) -> DataFrame:
    """Nodes of a level, below the given mismatches only, that differ or stand in one replica alone."""
    sides = []
    for side, name in ((a, "a"), (b, "b")):
        nodes = side.filter(F.col("level") == level).select(
            "archive", "node", F.col("digest").alias(f"digest_{name}"), F.col("record_id").alias(f"id_{name}"))
        if within is not None:
            above = within.select(F.col("archive").alias("up_archive"), F.col("node").alias("up"))
            nodes = nodes.join(above, (nodes["archive"] == above["up_archive"])
                               & (_up(nodes["node"], width) == above["up"]), "left_semi")
        sides.append(nodes)
    return sides[0].join(sides[1], ["archive", "node"], "full_outer").filter(
        ~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def audit(a: DataFrame, b: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> DataFrame:
    """``archive, offset, record_id, kind`` of every record that two replicas don't share:
    ``changed``, ``lost`` (in the first only) or ``added`` (in the second only)."""
    far = max(int(r.agg(F.coalesce(F.max("offset"), F.lit(0))).first()[0]) for r in (a, b))
    height = 1
    while far >= span * fanout ** (height - 1):
        height += 1
    left, right = tree(a, height, span, fanout), tree(b, height, span, fanout)
    bad = _mismatches(left, right, height, None, fanout)
    for level in range(height - 1, -1, -1):
        bad = _mismatches(left, right, level, bad, span if level == 0 else fanout)
    kind = F.when(F.col("digest_b").isNull(), "lost").when(F.col("digest_a").isNull(), "added").otherwise("changed")
    return bad.select("archive", F.col("node").alias("offset"), F.coalesce("id_a", "id_b").alias("record_id"),
                      kind.alias("kind"))
