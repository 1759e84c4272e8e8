"""Sources: volumes, catalogs, codebooks and the small text formats around them."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.tiles import parse_names

VOXELS = "path string, y int, x int, z int, value double"
_ROWS = 1 << 16


def decode_volume(path: str, content: bytes) -> np.ndarray:
    """[y, x, z] of a volume file by its extension: npy, raw (an int32 header ny, nx, nz, then uint16), tif or h5.

    The last two need libraries that are optional here.
    """
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "npy":
        return np.load(io.BytesIO(content))
    if kind == "raw":
        shape = np.frombuffer(content, "<i4", 3)
        return np.frombuffer(content, "<u2", offset=12).reshape(shape)
    if kind in ("tif", "tiff"):
        try:
            import tifffile
        except ImportError as e:
            raise RuntimeError("reading tif needs the tifffile library") from e
        return np.moveaxis(tifffile.imread(io.BytesIO(content)), 0, -1)
    if kind in ("h5", "hdf5"):
        try:
            import h5py
        except ImportError as e:
            raise RuntimeError("reading h5 needs the h5py library") from e
        with h5py.File(io.BytesIO(content)) as f:
            return np.transpose(f["image"][()])
    raise ValueError(f"unknown volume format: {path}")


def read_volumes(spark: SparkSession, paths: str | Sequence[str], planes: tuple[int, int] | None = None, keep_zeros: bool = True) -> DataFrame:
    """(path, y, x, z, value) of all volumes, 1-based; ``planes`` limits z (inclusive).

    Files are decoded in the executors, one at a time, and sent on in bounded batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                volume = decode_volume(path, content.as_py())
                volume = volume[:, :, None] if volume.ndim == 2 else volume
                low, high = planes or (1, volume.shape[2])
                for z in range(low, min(high, volume.shape[2]) + 1):
                    plane = volume[:, :, z - 1]
                    y, x = np.nonzero(plane) if not keep_zeros else (a.ravel() for a in np.indices(plane.shape))
                    for k in range(0, len(y), _ROWS):
                        ys, xs = y[k : k + _ROWS], x[k : k + _ROWS]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(ys)), pa.array((ys + 1).astype(np.int32)), pa.array((xs + 1).astype(np.int32)),
                             pa.array(np.full(len(ys), z, np.int32)), pa.array(plane[ys, xs].astype(float))],
                            names=["path", "y", "x", "z", "value"],
                        )

    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return files.select("path", "content").mapInArrow(run, VOXELS)


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """File names of a folder with what they say (base, scale, round, channel, variant, extension); contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    return parse_names(files).filter("base <> ''")


def image_dimensions(voxels: DataFrame, by: Sequence[str] = ("path",)) -> DataFrame:
    """(by, ny, nx, nz) from the largest positions."""
    return voxels.groupBy(*by).agg(*(F.max(a).alias(f"n{a}") for a in "yxz"))


def deinterleave(stack: DataFrame, planes: int, k: str = "k") -> DataFrame:
    """Raw planes k = 1.. of a multi-channel stack as (channel, z): channel by channel, ``planes`` each."""
    return stack.withColumn("channel", (F.floor((F.col(k) - 1) / planes) + 1).cast("int")).withColumn("z", ((F.col(k) - 1) % planes + 1).cast("int"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of one text file, lines from 0."""
    lines = spark.read.text(path, wholetext=True)
    return lines.select(F.posexplode(F.split("value", "\r?\n")).alias("line", "value")).filter(F.col("value") != "")


def read_tokens(lines: DataFrame) -> DataFrame:
    """(gene, y, x, z) of a line format where ``Colors: name`` begins a gene and ``Location: y x z`` adds a point of it."""
    gene = F.when(F.col("value").startswith("Colors:"), F.trim(F.substring("value", 8, 1 << 20)))
    named = lines.withColumn("gene", F.last(gene, ignorenulls=True).over(W.orderBy("line").rowsBetween(W.unboundedPreceding, 0)))
    at = F.split(F.trim(F.regexp_replace("value", "^Location:", "")), r"[\s,]+")
    return named.filter(F.col("value").startswith("Location:")).select("gene", *(at[k].cast("double").alias(a) for k, a in enumerate("yxz")))


def read_xml(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).load(path)


def stack_position(stacks: DataFrame, fov: int) -> DataFrame:
    """One row (row, col): the first stack whose pattern holds ``F<fov>``, else (-1, -1).

    ``stacks``: pattern, row, col and their order ``n``.
    """
    hit = stacks.filter(F.col("pattern").contains(f"F{fov:03d}"))
    found = hit.agg(F.min(F.struct("n", "row", "col")).alias("s"))
    return found.select(F.coalesce("s.row", F.lit(-1)).alias("row"), F.coalesce("s.col", F.lit(-1)).alias("col"))


def read_flat_yaml(text: str) -> dict[str, object]:
    """``key: value`` lines as a dict; numbers, booleans and [lists] are read as such, ``#`` begins a comment."""

    def value(raw: str) -> object:
        raw = raw.strip()
        if raw.startswith("[") and raw.endswith("]"):
            return [value(x) for x in raw[1:-1].split(",") if x.strip()]
        if raw.lower() in ("true", "false"):
            return raw.lower() == "true"
        for kind in (int, float):
            try:
                return kind(raw)
            except ValueError:
                pass
        return raw.strip("'\"")

    out = {}
    for line in text.splitlines():
        line = re.sub(r"(^|\s)#.*", "", line)
        if ":" in line and not line.startswith((" ", "\t", "-")):
            key, raw = line.split(":", 1)
            out[key.strip()] = value(raw)
    return out


def read_assignments(text: str) -> dict[str, str]:
    """``name = value;`` lines of a parameter script, comments (``%``) left out."""
    found = re.finditer(r"(?m)^([^% \n=]*) *= *([^;\n]*);", text)
    return {m[1]: m[2].strip() for m in found}


def natural_order(name: Column | str) -> Column:
    """A sort key in which every number of a name counts by its value."""
    c = F.col(name) if isinstance(name, str) else name
    parts = F.regexp_extract_all(c, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(p)), "")


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(name, rows) of stored tables; counts come from the files' footers, no column is read."""
    out = None
    for name, path in paths.items():
        part = spark.read.parquet(path).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def json_columns(df: DataFrame, column: str, schema: str) -> DataFrame:
    """``df`` with the fields of a JSON text column."""
    return df.withColumn("_json", F.from_json(column, schema)).select(*df.columns, "_json.*")
