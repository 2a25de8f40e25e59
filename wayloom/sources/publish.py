"""Publishing packed slices to a store, in an order that readers never see broken.

Archives come first, then the sidecars that describe them, then the index that names
them, and only when the index is seen to hold what was published are old generations
retired. A slice whose digest is the published one is skipped. Every file is
written under another name and moved into place, so a run that is cut off leaves the
store as it was, and the next one finishes the work.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import publish as rules
from . import features, shared

INDEX, KEEP = "index.json", 2


def _place(source: Path | bytes, target: Path) -> None:
    """Put a file in place whole, or not at all."""
    target.parent.mkdir(parents=True, exist_ok=True)
    temporary = target.with_name(f".{uuid.uuid4().hex}.part")
    if isinstance(source, bytes):
        temporary.write_bytes(source)
        size = len(source)
    else:
        shutil.copyfile(source, temporary)
        size = source.stat().st_size
    if temporary.stat().st_size != size:
        raise OSError(f"{target}: {temporary.stat().st_size} of {size} bytes were written")
    os.replace(temporary, target)


def drop_older(spark: SparkSession, folder: str, names: list[str], keep: int = 1) -> list[str]:
    """Remove the generations of slices in a folder but the newest; returns the files removed."""
    rows = [(f.name, f.stat().st_mtime_ns) for f in Path(folder).glob("*.wta")]
    if not rows or not names:
        return []
    files = spark.createDataFrame(rows, "file string, modified long")
    own = rules.own_generations(files, spark.createDataFrame([(n,) for n in names], "name string"))
    gone = sorted(r.file for r in rules.retained(own, keep).where("not keep").collect())
    for name in gone:
        (Path(folder) / name).unlink()
    return gone


def publish(spark: SparkSession, built: DataFrame, store: str, sidecars: dict[str, dict[str, str]] | None = None) -> list[tuple[str, str, str]]:
    """Publish archives by their index entries; returns (step, slice, what) in the order done.

    built: entries of `write_archives`, few as slices are. sidecars: for each slice the
    files to put beside it, by name in the store.
    """
    log: list[tuple[str, str, str]] = []
    top = Path(store)
    before = shared.optional(features.archive_index, spark, str(top / INDEX))
    old = [json.loads(x) for x in before.toJSON().collect()] if before is not None else []
    known = spark.createDataFrame([(x["slice"], x["version"], x["sha256"]) for x in old], "slice string, version string, sha string")
    entries = {(x["slice"], x["version"]): x for x in map(json.loads, built.toJSON().collect())}
    gated = built.select("slice", "version", F.col("sha256").alias("sha"))
    todo = sorted((r.slice, r.version) for r in rules.to_upload(gated, known).collect())
    log += [("skip", s, v) for s, v in sorted(set(entries) - set(todo))]
    for s, v in todo:
        own = entries[s, v]
        _place(Path(own["path"]), top / v / Path(own["path"]).name)
        own["path"] = f"{v}/{Path(own['path']).name}"
        log.append(("archive", s, own["path"]))
    for s in sorted({s for s, _ in todo}):
        for name, path in sorted((sidecars or {}).get(s, {}).items()):
            _place(Path(path), top / name)
            log.append(("sidecar", s, name))
    if todo:
        rest = [x for x in old if (x["slice"], x["version"]) not in todo]
        index = sorted(rest + [entries[k] for k in todo], key=lambda x: (x["slice"], x["version"]))
        _place(json.dumps(index).encode(), top / INDEX)
        now = features.archive_index(spark, str(top / INDEX)).select("slice", F.col("sha256").alias("sha"))
        for s, v in todo:
            rules.assert_indexed(now, s, entries[s, v]["sha256"])
            log.append(("index", s, v))
    for v in sorted({v for _, v in todo}):
        for name in drop_older(spark, str(top / v), [s for s, x in todo if x == v], KEEP):
            log.append(("retire", name.rpartition("-")[0], f"{v}/{name}"))
    return log
