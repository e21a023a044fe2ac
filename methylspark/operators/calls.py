"""Methylation calls by spot, and over all spots for mitochondrion and spike-ins."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from methylspark.functions import chemistry, formats
from methylspark.functions.chemistry import Assay
from methylspark.operators.aligned import as_sequenced, bases, depth_capped, overlaps_resolved, reference_sites


@dataclass(frozen=True)
class CallConfig:
    assay: Assay = Assay.TAPS
    min_mapq: int = 10
    min_base_quality: int = 30
    max_depth: int = 50_000
    trims: dict[str, tuple[int, int]] = field(default_factory=lambda: {"R1": (0, 0), "R2": (0, 0)})


def callable_records(records: DataFrame, config: CallConfig) -> DataFrame:
    """Properly paired primary records of enough mapping quality."""
    return records.where(F.col("flag").isin(*chemistry.PAIRED_FLAGS) & (F.col("mapq") >= config.min_mapq))


def spot_keys(whitelist: DataFrame) -> DataFrame:
    """All spots: spot_id, x, y, both barcodes and the two spellings of a record's CB. `whitelist` has ord, barcode_index, seq."""
    a = whitelist.select(F.col("barcode_index").alias("barcode1_index"), F.col("seq").alias("barcode1"), F.col("ord").alias("x"))
    b = whitelist.select(F.col("barcode_index").alias("barcode2_index"), F.col("seq").alias("barcode2"), F.col("ord").alias("y"))
    spot = F.concat_ws("_", "barcode1_index", "barcode2_index")
    return a.crossJoin(b).select(spot.alias("spot_id"), "x", "y", "barcode1_index", "barcode2_index", "barcode1", "barcode2", F.concat_ws("+", "barcode1", "barcode2").alias("raw_cb"))


def cb_to_spot(manifest: DataFrame, converted: bool = False) -> DataFrame:
    """(cb, spot_id) of every spelling; with `converted` also of barcodes in which C was read as T."""
    spellings = [F.col("raw_cb"), F.replace("raw_cb", F.lit("+"), F.lit(""))]
    if converted:
        spellings += [F.translate(c, "C", "T") for c in spellings]
    return manifest.select(F.explode(F.array_distinct(F.array(*spellings))).alias("cb"), "spot_id").distinct()


def with_spot(records: DataFrame, spots: DataFrame) -> DataFrame:
    """Records of known spots. A CB is looked up in upper case; one that is missing or unknown drops its record (see `unknown_cbs`)."""
    return records.where("cb is not null").withColumn("cb", F.upper("cb")).join(spots, "cb")


def unknown_cbs(records: DataFrame, spots: DataFrame) -> DataFrame:
    """CBs that no spot has, with their records' number."""
    return records.where("cb is not null").withColumn("cb", F.upper("cb")).join(spots, "cb", "left_anti").groupBy("cb").agg(F.count("*").alias("records"))


def with_target(records: DataFrame, targets: dict[str, list[str]], contig: str = "rname") -> DataFrame:
    """Records of the targets' contigs with `target`: the host's chromosomes, its mitochondrion, spikes. A contig is of one target; records of other contigs are left out."""
    if len(set(of := [c for names in targets.values() for c in names])) < len(of):
        raise ValueError("a contig is named for two targets")
    named = F.create_map(*(F.lit(x) for t, names in targets.items() for c in names for x in (c, t))) if of else F.lit(None)
    kept = records.where(F.col(contig).isin(*of)) if of else records.where(F.lit(False))
    return kept.withColumn("target", named[F.col(contig)] if of else F.lit(None).cast("string"))


def totals(calls: DataFrame, *keys: str) -> DataFrame:
    """How many sites calls have, and how many of them with depth, by these keys."""
    return calls.groupBy(*keys).agg(F.count("*").alias("processed"), F.count_if(F.col("meth") + F.col("unmeth") > 0).alias("covered"))


def trims_of(cutoffs: DataFrame, otherwise: dict[str, tuple[int, int]] | None) -> DataFrame:
    """One row of trims (R1_left, R1_right, R2_left, R2_right): those that `mbias.cutoffs` found for both reads, or else the given ones. Without given ones there is no row then, and a target that is called with it has no calls."""
    sides = {f"{r}_{side}": (r, side, otherwise[r][k] if otherwise else None) for r in ("R1", "R2") for k, side in enumerate(("left", "right"))}
    found = cutoffs.agg(F.count_distinct("read").alias("n"), *(F.max(F.when(F.col("read") == r, F.col(f"{side}_trim"))).alias(name) for name, (r, side, _) in sides.items()))
    found = found if otherwise else found.where("n = 2")
    return found.select(*(F.when(F.col("n") == 2, F.col(name)).otherwise(given).cast("int").alias(name) for name, (_, _, given) in sides.items()))


TRIM_COLUMNS = ("R1_left", "R1_right", "R2_left", "R2_right")


def _cut(config: CallConfig, trims: DataFrame | None) -> dict:
    """Trims by read: numbers, or the columns of a row that every record has."""
    return config.trims if trims is None else {r: (F.col(f"{r}_left"), F.col(f"{r}_right")) for r in ("R1", "R2")}


def _named(records: DataFrame) -> tuple[str, ...]:
    """The column that tells mates, if these records have one."""
    return ("qname",) if "qname" in records.columns else ()


def _good(placed: DataFrame, config: CallConfig, base: str, by: tuple[str, ...]) -> DataFrame:
    """Bases of enough quality, after what mates both cover is counted once."""
    single = overlaps_resolved(placed, base=base, by=by) if "qname" in placed.columns else placed
    return single.where(F.col("qual") >= config.min_base_quality)


def _counted(found: DataFrame, keys: list[str], methylated: Column) -> DataFrame:
    seen = found.withColumn("methylated", methylated).where("methylated is not null")
    counts = seen.groupBy(*keys).agg(F.count_if("methylated").alias("meth"), F.count_if(~F.col("methylated")).alias("unmeth"))
    return counts.withColumn("pct", formats.percent(F.col("meth"), F.col("unmeth")))


def call_cg(records: DataFrame, blocks: DataFrame, config: CallConfig, by: tuple[str, ...] = (), trims: DataFrame | None = None) -> DataFrame:
    """CpG counts by `by` (columns of the records), contig and position of the forward C: meth, unmeth, pct. `trims`, a row of `trims_of`, takes the place of the configured ones."""
    sites = reference_sites(blocks).where("context = 'CG'").select(F.col("contig").alias("rname"), "pos")
    records = counted = callable_records(records, config)
    if trims is not None:
        records = records.crossJoin(F.broadcast(trims))  # one row
    placed = bases(records, *by, *_named(records), *(TRIM_COLUMNS if trims is not None else ()), "ordinal", "flag", "rname")
    placed = _good(placed.join(sites, ["rname", "pos"]), config, "base", by)
    cut = [chemistry.trimmed(F.col("flag"), F.col("qpos") + k, F.col("length"), _cut(config, trims)) for k in (0, 1)]
    kept = depth_capped(placed, config.max_depth, counted).where(F.col("next_base").isNotNull() & ~cut[0] & ~cut[1])
    return _counted(kept, [*by, "rname", "pos"], chemistry.cg_methylated(F.concat("base", "next_base"), config.assay))


def call_ch(records: DataFrame, blocks: DataFrame, config: CallConfig, by: tuple[str, ...] = (), trims: DataFrame | None = None) -> DataFrame:
    """CH counts by `by`, contig, position, context and strand. On the plus strand the base sequenced next must be the context's second."""
    sites = reference_sites(blocks).where("context <> 'CG'").select(F.col("contig").alias("rname"), "pos", "context", "strand")
    records = counted = callable_records(records, config)
    if trims is not None:
        records = records.crossJoin(F.broadcast(trims))  # one row
    placed = as_sequenced(records, *by, *_named(records), *(TRIM_COLUMNS if trims is not None else ()), "ordinal", "rname")
    placed = _good(placed.join(sites, ["rname", "pos"]), config, "placed_base", by)
    cut = chemistry.trimmed(F.col("flag"), F.col("qpos"), F.col("length"), _cut(config, trims))
    follows = (F.col("strand") == "-") | (F.col("next_base") == F.right("context", F.lit(1)))
    kept = depth_capped(placed, config.max_depth, counted).where(~cut & follows)
    return _counted(kept, [*by, "rname", "pos", "context", "strand"], chemistry.ch_methylated(F.col("base"), F.col("strand"), config.assay))


def call_all(records: DataFrame, blocks: DataFrame, config: CallConfig, by: tuple[str, ...] = (), trims: DataFrame | None = None) -> DataFrame:
    """Calls of all contexts in one pass over the bases: `by`, contig, position, context (CG's too), strand, meth, unmeth, pct; rows as `call_cg` and `call_ch` give them."""
    sites = reference_sites(blocks).select(F.col("contig").alias("rname"), "pos", "context", "strand")
    records = counted = callable_records(records, config)
    if trims is not None:
        records = records.crossJoin(F.broadcast(trims))  # one row
    placed = as_sequenced(records, *by, *_named(records), *(TRIM_COLUMNS if trims is not None else ()), "ordinal", "rname")
    placed = _good(placed.join(sites, ["rname", "pos"]), config, "placed_base", by)
    cut = [chemistry.trimmed(F.col("flag"), F.col("qpos") + k, F.col("length"), _cut(config, trims)) for k in (0, 1)]
    is_cg = F.col("context") == "CG"
    follows = (F.col("strand") == "-") | (F.col("next_base") == F.right("context", F.lit(1)))
    fits = F.when(is_cg, F.col("placed_next").isNotNull() & ~cut[1]).otherwise(follows)
    kept = depth_capped(placed, config.max_depth, counted).where(~cut[0] & fits)
    methylated = F.when(is_cg, chemistry.cg_methylated(F.concat("placed_base", "placed_next"), config.assay)).otherwise(chemistry.ch_methylated(F.col("base"), F.col("strand"), config.assay))
    return _counted(kept, [*by, "rname", "pos", "context", "strand"], methylated)
