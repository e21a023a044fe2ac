"""A sample from its records to its reports, as one graph of DataFrames. Nothing runs before a result is asked for, but the fit of a saturation curve, whose 13 points are held when `saturation_of` is called."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.functions import chemistry
from methylspark.operators import calls, mbias, saturation, summary


@dataclass(frozen=True)
class SampleConfig:
    calls: calls.CallConfig = calls.CallConfig()
    bias: mbias.BiasConfig = mbias.BiasConfig()
    cutoff: mbias.CutoffConfig = mbias.CutoffConfig()
    mode: str = "both"
    mito: tuple[str, ...] = ("chrM",)
    #: The host's chromosomes (all but mitochondrion and spikes, if none is named), and each spike's contigs.
    chromosomes: tuple[str, ...] = ()
    spikes: dict[str, tuple[str, ...]] = field(default_factory=dict)
    #: Whether trims that the cycle bias of the host shows take the place of the configured ones, for host and mitochondrion; a spike's own for its.
    found_trims: bool = False
    #: With found trims: whether a target whose bias shows none is called with the configured ones; else it has no calls.
    keep_without_trims: bool = True
    reads_above: int = 10_000
    strict: bool = False


@dataclass(frozen=True)
class Sample:
    manifest: DataFrame
    reads: DataFrame
    cg: DataFrame
    ch: DataFrame | None
    mito: DataFrame
    mito_ch: DataFrame | None
    spikes: dict[str, tuple[DataFrame, DataFrame | None]]
    bias: DataFrame
    cutoffs: DataFrame
    per_spot: DataFrame


def sample(records: DataFrame, blocks: DataFrame, whitelist: DataFrame, config: SampleConfig) -> Sample:
    """All results of a sample's records (as `sources.files.with_cb` gives them). With `strict` an unknown CB is an error, else its records are left out."""
    contexts = chemistry.contexts(config.mode)
    manifest = calls.spot_keys(whitelist)
    spots = calls.cb_to_spot(manifest, converted=not config.calls.assay.converts_methylated)
    others = [*config.mito, *(c for names in config.spikes.values() for c in names)]
    host = records.where(F.col("rname").isin(*config.chromosomes)) if config.chromosomes else records.where(~F.col("rname").isin(*others))
    if config.strict:
        bad = calls.unknown_cbs(host, spots).agg(F.count("*").alias("n"))
        host = host.crossJoin(F.broadcast(bad)).where(F.when(F.col("n") > 0, F.raise_error(F.lit("a CB is not of the whitelist")).cast("boolean")).otherwise(True)).drop("n")
    with_ch = len(contexts) > 1 or contexts[0] != "CG"
    bias = mbias.cycles(host, blocks, config.bias)
    cutoffs = mbias.cutoffs(bias, config.cutoff)
    otherwise = config.calls.trims if config.keep_without_trims else None
    trims = calls.trims_of(cutoffs, otherwise) if config.found_trims else None

    def both(target: DataFrame, trims: DataFrame | None, by: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame | None]:
        return calls.call_cg(target, blocks, config.calls, by, trims), calls.call_ch(target, blocks, config.calls, by, trims) if with_ch else None

    cg, ch = both(calls.with_spot(host, spots), trims, ("spot_id",))
    mito, mito_ch = both(records.where(F.col("rname").isin(*config.mito)), trims)
    spikes = {}
    for name, contigs in config.spikes.items():
        own = records.where(F.col("rname").isin(*contigs))
        found = calls.trims_of(mbias.cutoffs(mbias.cycles(own, blocks, config.bias), config.cutoff), otherwise) if config.found_trims else None
        spikes[name] = both(own, found)
    stats = summary.context_stats(summary.all_contexts(cg if "CG" in contexts else None, ch))
    reads = summary.reads_per_spot(records, spots)
    return Sample(manifest, reads, cg, ch, mito, mito_ch, spikes, bias, cutoffs, summary.per_spot(manifest, reads, stats, contexts))


def saturation_of(found: Sample, config: SampleConfig) -> DataFrame:
    """The saturation row of a sample's spots with more than `reads_above` reads."""
    histogram = saturation.depth_histogram(found.cg, found.reads, config.reads_above)
    return saturation.summary(saturation.medians(saturation.expected_unique(histogram)))
