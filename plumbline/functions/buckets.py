"""Reproducible row selection by key, independent of partitioning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bucket:
    """Keys whose ``(multiplier * key + offset) mod modulus`` is in ``[start, start + width)``.

    On dense integer keys this takes exactly ``width / modulus`` of the rows,
    and the same ones for every layout and every re-run of a lost task. Text
    keys are hashed first.
    """

    multiplier: int
    modulus: int
    start: int
    width: int
    offset: int = 0

    def number(self, key: Column, hashed: bool = False) -> Column:
        residue = F.pmod(F.xxhash64(key) if hashed else key, F.lit(self.modulus))
        return F.pmod(residue * F.lit(self.multiplier) + F.lit(self.offset), F.lit(self.modulus))

    def holds(self, key: Column, hashed: bool = False) -> Column:
        number = self.number(key, hashed)
        return (number >= F.lit(self.start)) & (number < F.lit(self.start + self.width))
