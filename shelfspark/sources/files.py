"""File sources: trees, JSON lines, CSV in strings, refs, APK containers."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tree_files(spark: SparkSession, root: str, most_bytes: int = 256 * 1024) -> DataFrame:
    """(path, body, size) of all files below a folder up to a size; larger ones are never read."""
    got = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).filter(F.col("length") <= most_bytes)
    return got.select(F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "").alias("path"), F.make_valid_utf8(F.col("content").cast("string")).alias("body"), F.col("length").alias("size"))


def events(spark: SparkSession, path: str, kind: int) -> DataFrame:
    """Events of a kind with some content from JSON lines; a broken line fails the job."""
    schema = "kind int, pubkey string, created_at long, content string, tags array<array<string>>"
    got = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return got.filter((F.col("kind") == kind) & (F.trim("content") != ""))


def tag(name: str):
    """The value of the first tag of a name; null if there is none."""
    return F.get(F.filter("tags", lambda t: t[0] == name), F.lit(0))[1]


def csv_records(df: DataFrame, column: str, key: str) -> DataFrame:
    """(key, pos, record) of CSV text held in a column: quoted fields with doubled quotes, ragged rows allowed."""
    line = F.regexp_extract_all(F.col(column), F.lit(r'(?s)(?:"(?:[^"]|"")*"|[^"\n])+'), 0)
    field = lambda r: F.transform(F.regexp_extract_all(F.concat(F.lit(","), r), F.lit(r'(?s),("(?:[^"]|"")*"|[^,]*)'), 1), lambda f: F.when(f.startswith('"'), F.replace(F.regexp_replace(f, r'(?s)^"|"\z', ""), F.lit('""'), F.lit('"'))).otherwise(f))
    return df.select(key, F.posexplode(line).alias("pos", "line")).select(key, "pos", field(F.regexp_replace("line", r"\r\z", "")).alias("record"))


def git_refs(df: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, ref, sha) of a ref listing; a peeled tag's sha wins over the tag's own."""
    lines = df.select(key, F.explode(F.split(raw, "\n")).alias("l")).select(key, F.split(F.trim("l"), r"\s+").alias("p")).filter(F.size("p") == 2)
    refs = lines.select(key, F.regexp_replace(F.col("p")[1], r"\^\{\}\z", "").alias("ref"), F.col("p")[0].alias("sha"), F.col("p")[1].endswith("^{}").alias("peeled"))
    return refs.groupBy(key, "ref").agg(F.max_by("sha", "peeled").alias("sha"))


def _uleb(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def dex_names(data: bytes) -> tuple[list[str], list[str]]:
    """Strings of a DEX file, and the descriptors of the classes that it defines."""
    if data[:4] != b"dex\n":
        return [], []
    head = struct.unpack_from("<14I", data, 56)
    strings_n, strings_at, types_n, types_at, classes_n, classes_at = head[0], head[1], head[2], head[3], head[10], head[11]
    strings = []
    for (at,) in struct.iter_unpack("<I", data[strings_at : strings_at + 4 * strings_n]):
        _, begin = _uleb(data, at)
        strings.append(data[begin : data.index(0, begin)].decode("utf-8", "replace"))
    types = [strings[k] for (k,) in struct.iter_unpack("<I", data[types_at : types_at + 4 * types_n])]
    return strings, [types[struct.unpack_from("<I", data, classes_at + 32 * k)[0]] for k in range(classes_n)]


def apk_entries(content: bytes, most: int = 64 << 20) -> tuple[list[str], list[str]]:
    """Class paths and native library names of an APK; damaged containers have none."""
    classes: dict[str, None] = {}
    native: dict[str, None] = {}
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for entry in z.infolist():
                if entry.filename.startswith("lib/") and entry.filename.endswith(".so"):
                    native[entry.filename.rsplit("/", 1)[1]] = None
                elif entry.filename.endswith(".dex") and "/" not in entry.filename and entry.file_size <= most:
                    classes |= dict.fromkeys("/" + c[1:-1] for c in dex_names(z.read(entry))[1] if c[:1] == "L")
    except (zipfile.BadZipFile, struct.error, IndexError, ValueError):
        return [], []
    return list(classes), list(native)


def apk_parts(files: DataFrame, key: str, content: str) -> DataFrame:
    """(key, sha256, classes, native) of APK files held in a binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                classes, native = apk_entries(batch.column(2)[k].as_py() or b"")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([classes], pa.list_(pa.string())), pa.array([native], pa.list_(pa.string()))], names=["key", "sha256", "classes", "native"])

    kind = files.schema[key].dataType.simpleString()
    return files.select(F.col(key), F.sha2(content, 256), F.col(content)).mapInArrow(run, f"key {kind}, sha256 string, classes array<string>, native array<string>").withColumnRenamed("key", key)
