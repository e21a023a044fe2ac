"""The rules of the assays, shared by the cycle-bias, spot and aggregate callers."""

from __future__ import annotations

from enum import StrEnum

from pyspark.sql import Column
from pyspark.sql import functions as F


class Assay(StrEnum):
    TAPS = "taps"
    TAPS_V2 = "taps-v2"
    EMSEQ = "emseq"
    CABERNET = "cabernet"

    @property
    def converts_methylated(self) -> bool:
        """Whether the methylated C is the one that is read as T."""
        return self in (Assay.TAPS, Assay.TAPS_V2)


#: Flags of properly paired primary records.
PAIRED_FLAGS = (83, 99, 147, 163)
CONTEXTS = {"cg": ("CG",), "ch": ("CA", "CC", "CT"), "both": ("CG", "CA", "CC", "CT")}


def contexts(mode: str) -> tuple[str, ...]:
    if mode not in CONTEXTS:
        raise ValueError(f"context mode must be one of {', '.join(CONTEXTS)}")
    return CONTEXTS[mode]


def is_reverse(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(16)) != 0


def is_read1(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(64)) != 0


def is_read2(flag: Column) -> Column:
    return flag.bitwiseAND(F.lit(128)) != 0


def site(previous: Column, base: Column, following: Column) -> Column:
    """struct(context, strand) of a reference base, or null: CG at its C, CH at its C (+) or, for the other strand, at its G (-)."""
    plus = F.when(following == "G", F.struct(F.lit("CG").alias("context"), F.lit("+").alias("strand"))).when(following.isin("A", "C", "T"), F.struct(F.concat(F.lit("C"), following).alias("context"), F.lit("+").alias("strand")))
    minus = F.when(previous.isin("A", "G", "T"), F.struct(F.concat(F.lit("C"), F.translate(previous, "AGT", "TCA")).alias("context"), F.lit("-").alias("strand")))
    return F.when(base == "C", plus).when(base == "G", minus)


def trimmed(flag: Column, qpos: Column, length: Column, trims: dict[str, tuple[int | Column, int | Column]]) -> Column:
    """Whether a base lies in its read's left or right trim, counted in sequencing direction."""
    left, right = (F.when(is_read1(flag), trims["R1"][k]).when(is_read2(flag), trims["R2"][k]).otherwise(0) for k in (0, 1))
    from_start = F.when(is_reverse(flag), length - qpos).otherwise(qpos + 1)
    from_end = F.when(is_reverse(flag), qpos + 1).otherwise(length - qpos)
    return ((left > 0) | (right > 0)) & ((from_start <= left) | (from_end <= right))


def cg_methylated(pair: Column, assay: Assay) -> Column:
    """Whether two neighbouring bases at a CpG show methylation; null for other bases."""
    changed = F.when(pair.isin("TG", "CA"), True).when(pair == "CG", False)
    return changed if assay.converts_methylated else ~changed


def ch_methylated(base: Column, strand: Column, assay: Assay) -> Column:
    """The same for a base as sequenced at a CH site."""
    kept = F.when(strand == "+", F.when(base == "C", True).when(base == "T", False)).otherwise(F.when(base == "G", True).when(base == "A", False))
    return ~kept if assay.converts_methylated else kept


def cycle(flag: Column, qpos: Column, length: Column, r1_length: int) -> Column:
    """1-based sequencing cycle; the first read counts from what was cut off its front. A read longer than that is an error."""
    offset = F.lit(0)
    if r1_length:
        offset = F.when(is_read1(flag), F.when(length > r1_length, F.raise_error(F.lit("a trimmed R1 is longer than the original")).cast("int")).otherwise(r1_length - length)).otherwise(0)
    return offset + F.when(is_reverse(flag), length - qpos).otherwise(qpos + 1)


def uniquely_mapped(flag: Column, mapq: Column, nh: Column, least: int) -> Column:
    """Mapped, of this quality, and NH absent, not a number or at most 1."""
    return (flag.bitwiseAND(F.lit(4)) == 0) & (mapq >= least) & (F.coalesce(nh.try_cast("int"), F.lit(1)) <= 1)
