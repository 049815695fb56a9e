"""Bitmaps of hashed keys: a join partner of bounded size that tells which rows may have a partner at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap in one row, and rows at most: 16 MB.
ROW_BITS, MAX_ROWS = 32_768, 4096


def _row(key: str, rows: int) -> Column:
    return F.shiftrightunsigned(key, 32).bitwiseAND(rows - 1)


def _bit_set(key: str) -> Column:
    """Whether the key's bit is set in the row of the bitmap at hand."""
    bit = F.col(key).bitwiseAND(ROW_BITS - 1)
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.floor(byte / F.pow(F.lit(2.0), bit.bitwiseAND(7))) % 2 == 1, F.lit(False))


class Bitmap:
    """Bitmap of a column of hashes. It follows the number of keys up to its bound; a full one lets more rows through,
    and never stops one whose key it holds."""

    def __init__(self, keys: DataFrame, key: str, expected: int):
        rows = 1
        while rows < MAX_ROWS and rows * ROW_BITS < 16 * expected:
            rows *= 2
        self.rows = rows
        bits = F.bitmap_construct_agg(F.col(key).bitwiseAND(ROW_BITS - 1)).alias("_bits")
        self.bits = keys.groupBy(_row(key, rows).alias("_row")).agg(bits)

    def marked(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with a column that is true where the hash ``key`` may be in the bitmap."""
        joined = df.withColumn("_row", _row(key, self.rows)).join(F.broadcast(self.bits), "_row", "left")
        return joined.withColumn(name, _bit_set(key)).drop("_row", "_bits")

    def maybe(self, df: DataFrame, key: str) -> DataFrame:
        """Rows whose hash ``key`` may be in the bitmap."""
        kept = df.columns
        return df.withColumn("_row", _row(key, self.rows)).join(F.broadcast(self.bits), "_row").filter(_bit_set(key)).select(*kept)


class WordBitmap(Bitmap):
    """The same with its rows as arrays of 64-bit words: a look-up copies no row, which pays for many look-ups a bit."""

    def __init__(self, keys: DataFrame, key: str, expected: int):
        super().__init__(keys, key, expected)
        word = lambda i: F.conv(F.hex(F.substring("_bits", (i * 8 + 1).cast("int"), F.lit(8))), 16, -10).cast("long")
        self.bits = self.bits.select("_row", F.transform(F.sequence(F.lit(0), F.lit(ROW_BITS // 64 - 1)), word).alias("_words"))

    def maybe(self, df: DataFrame, key: str) -> DataFrame:
        # Bytes count from the lowest bit, words from the highest byte.
        bit = f"({key} & {ROW_BITS - 1})"
        found = f"shiftright(get(_words, cast(shiftright({bit}, 6) as int)), cast(56 - 8 * (shiftright({bit}, 3) & 7) + ({bit} & 7) as int)) & 1"
        joined = df.withColumn("_row", _row(key, self.rows)).join(F.broadcast(self.bits), "_row")
        return joined.filter(f"({found}) = 1").select(*df.columns)
