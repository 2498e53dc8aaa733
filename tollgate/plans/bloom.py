"""A Bloom filter over a key table, as an aggregate read by a scalar subquery.

It thins the rows of a large table before an equi-join with a table that is too
large to broadcast: rows whose key cannot be in the key table never reach the
shuffle.  The filter has at most ``MAX_WORDS`` words of 64 bits (8 MB), however
many keys there are; with more keys than that suits, it lets more rows through
and is never wrong about a key that is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY, PROBES, MAX_WORDS = 12, 5, 1 << 20


def _place(key: Column, probe: int, words: int) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(F.lit(probe), key), F.lit(words * 64))
    return F.floor(at / F.lit(64)).cast("int"), (at % 64).cast("int")


class Bloom:
    """``Bloom(keys, "domain").may_hold(column)``: false only for absent keys.

    The number of keys (a count) sets the size; the words are a partial
    ``bit_or`` and end in one row of bounded size."""

    def __init__(self, keys: DataFrame, key: str, max_words: int = MAX_WORDS):
        self.words = min(max_words, keys.count() * BITS_PER_KEY // 64 + 1)
        bits = keys.select(F.explode(F.array(*[
            F.struct(w.alias("w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), b).alias("b"))
            for w, b in (_place(F.col(key), p, self.words) for p in range(PROBES))])).alias("x")).select("x.*")
        # Every word once, so that a word is found by its place in the array.
        blank = keys.sparkSession.range(self.words).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("bigint").alias("b"))
        whole = bits.unionByName(blank).groupBy("w").agg(F.bit_or("b").alias("b"))
        packed = whole.agg(F.array_sort(F.collect_list(F.struct("w", "b"))).alias("ws"))
        self._bits = packed.select(F.transform("ws", lambda x: x["b"]).alias("bits")).scalar()

    def may_hold(self, key: Column) -> Column:
        out = F.lit(True)
        for p in range(PROBES):
            w, b = _place(key, p, self.words)
            out = out & (F.call_function("shiftrightunsigned", F.get(self._bits, w), b).bitwiseAND(F.lit(1).cast("bigint")) == 1)
        return out
