"""A sample's configuration from a file of shell variables, with the environment in front of a file's defaults.

Lines are NAME=${NAME:-default}, which a variable of the environment that isn't empty overrides, NAME=value or NAME=${OTHER}, and tables,
declare -A NAME=( [key]="value" ... ). Comments and all else that isn't such a line are passed over.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import replace

from methylspark.functions.chemistry import Assay
from methylspark.operators import barcodes, calls, mbias
from methylspark.plans.sample import SampleConfig
from methylspark.sources.reports import contig_list

_LINE = re.compile(r"^\s*(?:export\s+)?([A-Z][A-Z0-9_]*)=(.*)$")
_TABLE = re.compile(r"^\s*declare\s+-A\s+([A-Z][A-Z0-9_]*)=\(\s*$")
_ENTRY = re.compile(r"""^\s*\[([^]]+)\]=(?:"([^"]*)"|'([^']*)'|(\S*))""")
_USE = re.compile(r"\$\{([A-Z][A-Z0-9_]*)(?::-((?:[^{}]|\{[^}]*\})*))?\}")


def parse(text: str, environment: Mapping[str, str]) -> dict[str, str | dict[str, str]]:
    """Values by name; later lines see earlier ones."""
    out: dict[str, str | dict[str, str]] = {}
    table: dict[str, str] | None = None

    def used(match: re.Match) -> str:
        name, default = match.groups()
        known = environment.get(name) or out.get(name)
        return known if isinstance(known, str) and known else _USE.sub(used, default or "")

    for line in text.splitlines():
        if table is not None:
            if line.strip() == ")":
                table = None
            elif entry := _ENTRY.match(line):
                table[entry[1]] = _USE.sub(used, next((v for v in entry.groups()[1:] if v is not None), ""))
        elif found := _TABLE.match(line):
            table = out[found[1]] = {}
        elif found := _LINE.match(line):
            value = found[2].strip()
            if value[:1] in ("'", '"') and value.find(value[0], 1) > 0:
                value = value[1 : value.find(value[0], 1)]
            else:
                value = re.sub(r"(^|\s)#.*$", "", value).strip()
            out[found[1]] = _USE.sub(used, value)
    return out


def read_settings(path: str, environment: Mapping[str, str] | None = None) -> dict[str, str | dict[str, str]]:
    with open(path, encoding="utf-8") as f:  # a small file of the driver, read before there is a job
        return parse(f.read(), os.environ if environment is None else environment)


def _number(settings: Mapping, name: str, otherwise: float) -> float:
    text = settings.get(name) or otherwise
    try:
        value = float(text)
    except (TypeError, ValueError):
        raise ValueError(f"{name} is no number: {text}") from None
    if value < 0:
        raise ValueError(f"{name} is below 0: {text}")
    return value


def sample_config(settings: Mapping, assay: Assay, spikes: Mapping[str, list[str]] | None = None) -> SampleConfig:
    """The configuration of a sample. `spikes` names the contigs of each spike-in, as its reference has them; a name that is missing keeps the default."""
    base = SampleConfig()
    whole = lambda name, otherwise: int(_number(settings, name, otherwise))
    bias = mbias.BiasConfig(
        assay=assay, min_mapq=whole("MBIAS_MIN_MAPPING_QUALITY", base.bias.min_mapq), min_base_quality=whole("MBIAS_MIN_BASE_QUALITY", base.bias.min_base_quality), max_cycle=whole("MBIAS_MAX_CYCLE", base.bias.max_cycle), r1_length=whole("MBIAS_R1_ORIGINAL_LENGTH", base.bias.r1_length),
        fraction=_number(settings, "MBIAS_HOST_SUBSAMPLE_FRACTION", base.bias.fraction), seed=whole("MBIAS_SAMPLING_SEED", base.bias.seed), max_records=whole("MBIAS_HOST_MAX_RECORDS", base.bias.max_records), replay=True,
    )
    called = calls.CallConfig(assay, whole("CALL_MIN_MAPPING_QUALITY", base.calls.min_mapq), whole("CALL_MIN_BASE_QUALITY", base.calls.min_base_quality), whole("CALL_MAX_DEPTH", base.calls.max_depth))
    return replace(
        base, calls=called, bias=bias, cutoff=replace(base.cutoff, r1_length=bias.r1_length), mode=str(settings.get("CALL_CONTEXT_MODE") or base.mode), mito=tuple(contig_list(str(settings.get("CALL_MITO_CHROMOSOMES") or ",".join(base.mito)))),
        chromosomes=tuple(contig_list(str(settings.get("CALL_CHROMOSOMES") or ""))), spikes={k: tuple(v) for k, v in (spikes or {}).items()}, reads_above=whole("SATURATION_READS_THRESHOLD", base.reads_above),
    )


def layout(settings: Mapping, assay: Assay) -> barcodes.Layout:
    """Where barcodes, linker and insert stand in R1, by the same settings."""
    base = barcodes.Layout(assay)
    return replace(
        base, linker=str(settings.get("BARCODE_LINKER_BC") or base.linker), insert_left=str(settings.get("BARCODE_INSERT_LEFT") or base.insert_left), linker_edits=int(_number(settings, "BARCODE_LINKER_EDIT_DISTANCE", base.linker_edits)),
        insert_mismatches=int(_number(settings, "BARCODE_INSERT_LEFT_EDIT_DISTANCE", base.insert_mismatches)), barcode_distance=int(_number(settings, "BARCODE_HAMMING_DISTANCE", base.barcode_distance)),
    )
