"""Coverage files in their own layout: host/<first index>/<spot>.<context>.cov, and <target>.<context>.cov for calls over all spots.

Rows of a file come to one task, sorted; it writes its files below a folder of its own, and only when all tasks are done do files get their names. A failed or repeated
task leaves nothing behind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from methylspark.sinks.files import coverage_lines

#: Files that are renamed at once when all tasks are done.
MOVERS = 16


def _system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """A task's folder and the files in it."""

    folder: str
    files: list[str]


class CoverageWriter(DataSourceArrowWriter):
    """Writes rows (file, value): each file's lines, all in a row."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.expected = options["path"].rstrip("/"), json.loads(options.get("expected", "[]"))
        #: What files of an earlier run that go begin with, below the path.
        self.replaced = options["replaced"] if overwrite else None
        self.stage = f"{self.path}/.writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, stage = _system(self.stage)
        folder, files, out = f"{stage}/{uuid.uuid4().hex}", [], None
        try:
            for b in iterator:
                names, lines = b.column(0).to_pylist(), b.column(1).to_pylist()
                lo = 0
                while lo < len(names):
                    hi = lo + 1
                    while hi < len(names) and names[hi] == names[lo]:
                        hi += 1
                    if not files or names[lo] != files[-1]:
                        if names[lo] in files:
                            raise ValueError(f"rows of {names[lo]} aren't together")
                        if out:
                            out.close()
                        at = f"{folder}/{names[lo]}"
                        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
                        out = system.open_output_stream(at)
                        files.append(names[lo])
                    out.write(("\n".join(lines[lo:hi]) + "\n").encode())
                    lo = hi
        finally:
            if out:
                out.close()
        return Written(folder, files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = _system(self.path)
        moved = [(f"{m.folder}/{name}", name) for m in messages if m for name in m.files]
        named = [name for _, name in moved]
        if len(set(named)) < len(named):
            raise ValueError("a coverage file was written by two tasks")
        if self.replaced is not None:
            self._clear(system, root)
        for folder in {f"{root}/{name}".rsplit("/", 1)[0] for name in [*named, *self.expected]}:
            system.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda x: system.move(x[0], f"{root}/{x[1]}"), moved))
        for name in set(self.expected).difference(named):
            system.open_output_stream(f"{root}/{name}").close()
        self.abort(messages)

    def _clear(self, system, root: str) -> None:
        """Removes coverage files of an earlier run."""
        from pyarrow import fs

        for found in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if found.type == fs.FileType.File and found.path.endswith(".cov") and "/.writing-" not in found.path and found.path.startswith(f"{root}/{self.replaced}"):
                system.delete_file(found.path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, stage = _system(self.stage)
        if system.get_file_info(stage).type.name == "Directory":
            system.delete_dir(stage)


class CoverageSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "coverage"

    def schema(self) -> str:
        return "file string, value string"

    def writer(self, schema, overwrite: bool) -> CoverageWriter:
        return CoverageWriter(dict(self.options), overwrite)


def _write(lines: DataFrame, path: str, keys: tuple[str, ...], replaced: str, expected: list[str]) -> None:
    lines.sparkSession.dataSource.register(CoverageSink)
    placed = lines.repartition("file").sortWithinPartitions("file", *keys).select("file", "value")
    placed.write.format("coverage").mode("overwrite").option("path", path).option("replaced", replaced).option("expected", json.dumps(expected)).save()


def _order(contigs: list[str]) -> Column:
    """A contig's place in the configured order; those not named come after, by name."""
    places = F.create_map(*(F.lit(x) for k, c in enumerate(contigs) for x in (c, k))) if contigs else None
    return F.coalesce(places[F.col("rname")], F.lit(len(contigs))) if contigs else F.lit(0)


KEYS = ("contig_place", "rname", "pos", "context", "strand")


def _lines(calls: DataFrame, file: Column, contigs: list[str]) -> DataFrame:
    """(file, value) and the columns that lines are sorted by. Calls have a context and strand, as `call_all` gives them, or are of CG alone."""
    if "context" not in calls.columns:
        calls = calls.withColumns({"context": F.lit("CG"), "strand": F.lit("+")})
    named = calls.withColumns({"file": file, "contig_place": _order(contigs)})
    cg = coverage_lines(named.where("context = 'CG'").withColumnsRenamed({"context": "kind", "strand": "side"}), "file", "contig_place", "kind", "side").withColumnsRenamed({"kind": "context", "side": "strand"})
    ch = coverage_lines(named.where("context <> 'CG'"), "file", "contig_place", "context", "strand")
    return cg.unionByName(ch)


def write_spot_coverage(calls: DataFrame, path: str, contigs: list[str]) -> None:
    """A file host/<first index>/<spot>.<context>.cov for each spot and context that has a row; contigs in the given order, then by position, context and strand."""
    context = F.col("context") if "context" in calls.columns else F.lit("CG")
    file = F.concat(F.lit("host/"), F.split_part("spot_id", F.lit("_"), F.lit(1)), F.lit("/"), F.col("spot_id"), F.lit("."), context, F.lit(".cov"))
    _write(_lines(calls, file, contigs), path, KEYS, "host/", [])


def write_target_coverage(calls: DataFrame, path: str, target: str, contexts: tuple[str, ...], contigs: list[str]) -> None:
    """A file <target>.<context>.cov for each of the contexts, empty where no call is of it. Other targets' files in the folder stay."""
    context = F.col("context") if "context" in calls.columns else F.lit("CG")
    chosen = calls.where(context.isin(*contexts))
    _write(_lines(chosen, F.concat(F.lit(f"{target}."), context, F.lit(".cov")), contigs), path, KEYS, f"{target}.", [f"{target}.{c}.cov" for c in contexts])
