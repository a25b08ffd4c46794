"""A Bloom filter of keys, aggregated by Spark and applied as a plain column expression.

A side of a join whose rows mostly find no partner (98 % of activity extensions are orphans) is shuffled
whole by a join.  A filter of the other side's keys drops almost all orphans in the scan stage, before
the exchange, and the join then gives the same rows.

The filter has a fixed number of bits, ``2**bits``, chosen from the number of keys (about ``BITS_PER_KEY``
a key) and never above ``2**MAX_BITS`` (8 MB).  A key sets up to ``HASHES`` bits of one 64-bit word: one hash names the
word, another one the bits.  Words are built by an aggregation of ``bit_or``, whose partial step runs in the
map tasks, and joined to one binary in pieces.  It is applied as a scalar subquery of the plan, which Spark runs
with the query: its bytes are in no plan text (a literal of 8 MB is printed with every node that holds it, each time the
plan is reported) and are named once per filter; the word of a key is read with built-in functions.
A false positive keeps a row that the join then drops; no key of the filter is ever dropped.  A null key
is never in the filter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 10
HASHES = 5
MIN_BITS, MAX_BITS = 10, 26
#: Words of a piece, as a power of two: pieces are joined in parallel before the whole is.
PIECE = 10


@dataclass(frozen=True)
class Bloom:
    bits: int
    words: DataFrame  # one row, one binary column

    def might_contain(self, key: Column) -> Column:
        """True for every key put in, and for a small share of others (about 1 % at ``BITS_PER_KEY``); false for null."""
        word, mask = _place(key, self.bits)
        found = F.substring(self.words.scalar(), (word * 8 + 1).cast("int"), 8)
        # base -10: as a signed number
        found = F.conv(F.hex(found), 16, -10).cast("long")
        return key.isNotNull() & F.coalesce(found.bitwiseAND(mask) == mask, F.lit(False))


def _place(key: Column, bits: int) -> tuple[Column, Column]:
    """The word of a key, and its bits in that word."""
    word = F.pmod(F.xxhash64(key), F.lit(1 << (bits - 6)).cast("long"))
    second = F.xxhash64(key, F.lit("second hash"))
    mask = F.lit(0).cast("long")
    for i in range(HASHES):
        at = F.shiftright(second, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return word, mask


def size_for(keys: int) -> int:
    """Bits (as a power of two) for a number of keys."""
    bits = MIN_BITS
    while bits < MAX_BITS and (1 << bits) < keys * BITS_PER_KEY:
        bits += 1
    return bits


def build(df: DataFrame, key: str, keys: int | None = None) -> Bloom:
    """The filter of the non-null values of a column; ``keys`` (counted where not given) sets its size."""
    values = df.select(F.col(key).alias("k")).filter(F.col("k").isNotNull())
    bits = size_for(values.count() if keys is None else keys)
    word, mask = _place(F.col("k"), bits)
    probes = values.select(word.alias("w"), mask.alias("b"))
    # every word has a row, also one without a bit
    blank = df.sparkSession.range((1 << bits) // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
    words = probes.unionAll(blank).groupBy("w").agg(F.lpad(F.hex(F.bit_or("b")), 16, "0").alias("h"))
    pieces = words.groupBy(F.shiftright("w", PIECE).alias("w")).agg(_joined("w", "h").alias("h"))
    return Bloom(bits, pieces.agg(F.unhex(_joined("w", "h")).alias("words")))


def _joined(order: str, text: str) -> Column:
    """The texts of a group, one after the other in an order."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text]), "")
