"""Archives and model files: tar.zst snapshots, safetensors, packages by hash."""

from __future__ import annotations

import io
import json
import struct
import tarfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions import vectors
from shelfspark.operators.listing import on_platform

_ENTRY = "archive string, name string, content binary"


def _unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content))
            with tarfile.open(fileobj=stream, mode="r|") as archive:
                for member in archive:
                    if member.isfile():
                        yield pd.DataFrame({"archive": [path], "name": [member.name], "content": [archive.extractfile(member).read()]})


def archive_entries(spark: SparkSession, path: str, glob: str = "*.tar.zst") -> DataFrame:
    """(archive, name, content) of the files in the tar.zst archives below a folder; one is unpacked as a stream, entry by entry."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInPandas(_unpack, _ENTRY)


def snapshot_listings(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Listings from the JSON lines in snapshot archives, those of the platform that is enriched; a broken line fails the job. ``schema`` has app_id and tags."""
    lines = archive_entries(spark, path).filter(F.col("name").rlike(r"\.jsonl?\z")).select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")).filter(F.trim("line") != "")
    return lines.select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("l")).select("l.*").filter(on_platform(F.col("tags")))


def tensors(raw: bytes, names: tuple[str, ...] = ()) -> dict[str, np.ndarray]:
    """32-bit float tensors of a safetensors file by name, all or the named ones; a wrong type or range is an error."""
    size = struct.unpack_from("<Q", raw)[0]
    head = json.loads(raw[8 : 8 + size])
    out = {}
    for name in names or [n for n in head if n != "__metadata__"]:
        about = head[name]
        begin, end = about["data_offsets"]
        shape = about["shape"]
        if about["dtype"] != "F32" or end - begin != 4 * int(np.prod(shape, dtype=np.int64)) or 8 + size + end > len(raw):
            raise ValueError(f"tensor {name} is no 32-bit float tensor of its shape")
        out[name] = np.frombuffer(raw, "<f4", (end - begin) // 4, 8 + size + begin).reshape(shape)
    return out


def dense(raw: bytes, weight: str = "linear.weight", bias: str = "linear.bias") -> tuple[list[list[float]], list[float]]:
    """Weights and biases of a dense layer from a safetensors file, as ``vectors.project`` takes them."""
    got = tensors(raw, (weight, bias))
    return got[weight].tolist(), got[bias].tolist()


def encode_text(pooled: Column, weights: list[list[float]], bias: list[float]) -> Column:
    """The stored vector of a pooled hidden state: projected, of unit length, as signed bytes."""
    return vectors.quantize(vectors.l2(vectors.project(pooled, weights, bias)))


def verified(files: DataFrame, wanted: DataFrame, key: str = "app_id") -> DataFrame:
    """(key, content) of files whose SHA-256 is the one wanted for the key, case aside; an empty wish matches nothing."""
    want = wanted.filter(F.trim("hash") != "").select(key, F.lower(F.trim("hash")).alias("__want"))
    return files.join(want, key).filter(F.sha2("content", 256) == F.col("__want")).select(key, "content")
