"""Android's binary resources by their public format: XML documents, string tables, and what an APK says in them.

Chunks are read one inside the other by their headers; everything comes out as
rows, so that joins and counts are DataFrame work.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from struct import unpack_from

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions import urls

# Fixed values of the format: kinds of chunks, of attribute values, and flags.
POOL, TABLE, XML, PACKAGE, TYPE, START = 0x0001, 0x0002, 0x0003, 0x0200, 0x0201, 0x0102
STRING, INTEGER, BOOLEAN = 0x03, 0x10, 0x12
UTF8, SPARSE, OFFSET16, COMPLEX, COMPACT = 1 << 8, 0x01, 0x02, 0x01, 0x08
# Hosts that an APK names beside those that say nothing anyway; endings of files that can name hosts.
SKIPPED_HOSTS = ("developer.android.com", "maven.google.com")
HOST_ENDINGS = (".xml", ".json", ".txt", ".properties", ".js", ".html")
MOST_HOSTS, LARGEST_FILE, LARGEST_TABLE = 32, 16 << 20, 64 << 20


def chunks(data: memoryview, at: int = 0) -> Iterator[tuple[int, memoryview]]:
    """(kind, chunk) of the chunks that follow each other from ``at``; ends where a size makes no sense."""
    while at + 8 <= len(data):
        kind, _, size = unpack_from("<HHI", data, at)
        if size < 8 or at + size > len(data):
            return
        yield kind, data[at : at + size]
        at += size


def header(chunk: memoryview) -> int:
    return unpack_from("<H", chunk, 2)[0]


def pool(chunk: memoryview) -> list[str]:
    """All strings of a pool; what can't be read is empty."""
    count, _, flags, start = unpack_from("<4I", chunk, 8)
    head = header(chunk)
    if head + 4 * count > len(chunk):
        return []
    wide = not flags & UTF8

    def length(at: int) -> tuple[int, int]:
        """A length of one or two units, and where it ends."""
        step, top = (2, 0x8000) if wide else (1, 0x80)
        first = unpack_from("<H" if wide else "B", chunk, at)[0]
        if not first & top:
            return first, at + step
        more = unpack_from("<H" if wide else "B", chunk, at + step)[0]
        return (first & (top - 1)) << (8 * step) | more, at + 2 * step

    out = []
    for offset in unpack_from(f"<{count}I", chunk, head):
        try:
            at = start + offset
            n, at = length(at)
            if not wide:
                n, at = length(at)
            raw = bytes(chunk[at : at + n * (2 if wide else 1)])
            out.append(raw.decode("utf-16-le" if wide else "utf-8", "replace") if len(raw) == n * (2 if wide else 1) else "")
        except Exception:  # noqa: BLE001  a damaged entry is empty, the others stand
            out.append("")
    return out


def elements(raw: bytes) -> list[tuple[str, dict[str, str]]]:
    """(name, attributes) of each element of a binary XML document, or of a plain one, in order; empty if it is neither."""
    data = memoryview(raw)
    if len(raw) < 8 or unpack_from("<H", data)[0] != XML:
        return _plain_elements(raw)
    names: list[str] = []
    out = []
    for kind, chunk in chunks(data, header(data)):
        if kind == POOL:
            names = pool(chunk)
        elif kind == START:
            body = header(chunk)
            _, name, first, size, count = unpack_from("<2I3H", chunk, body)
            found = {}
            for k in range(count):
                _, key, text, _, _, type_, value = unpack_from("<3IHBBI", chunk, body + first + k * size)
                found[_at(names, key)] = _at(names, value if type_ == STRING else text) if type_ == STRING or text != 0xFFFFFFFF else _value(type_, value)
            out.append((_at(names, name), found))
    return out


def _plain_elements(raw: bytes) -> list[tuple[str, dict[str, str]]]:
    from xml.etree import ElementTree

    local = lambda x: x.rpartition("}")[2]
    try:
        return [(local(e.tag), {local(k): v for k, v in e.attrib.items()}) for e in ElementTree.fromstring(raw).iter() if isinstance(e.tag, str)]
    except ElementTree.ParseError:
        return []


def _at(names: list[str], k: int) -> str:
    return names[k] if k < len(names) else ""


def _value(type_: int, value: int) -> str:
    if type_ == BOOLEAN:
        return "true" if value else "false"
    return str(value) if type_ == INTEGER else f"@0x{value:08x}"


def signals(raw: bytes) -> dict:
    """Package, version, permissions and components of a manifest; names are completed by the package."""
    package, version, permissions, components = "", "", [], []
    for tag, found in elements(raw):
        name = found.get("name", "").strip()
        if tag == "manifest":
            package, version = found.get("package", ""), found.get("versionName", "")
        elif tag in ("uses-permission", "uses-permission-sdk-23", "uses-permission-sdk-m") and name:
            permissions.append(name)
        elif tag in ("activity", "service", "receiver", "provider", "meta-data") and name:
            components.append(package + name if package and name[0] == "." else f"{package}.{name}" if package and "." not in name else name)
    return {"package": package, "version": version, "permissions": permissions, "components": components}


def table_strings(raw: bytes) -> Iterator[tuple[str, str, str]]:
    """(language, key, value) of the strings of a resource table, language empty for the default; values of translations are empty."""
    data = memoryview(raw)
    if len(raw) < 12 or unpack_from("<H", data)[0] != TABLE:
        raise ValueError("not a resource table")
    texts: list[str] = []
    for kind, chunk in chunks(data, header(data)):
        if kind == POOL and not texts:
            texts = pool(chunk)
        elif kind == PACKAGE and len(chunk) >= 288:
            yield from _package_strings(chunk, texts)


def _package_strings(chunk: memoryview, texts: list[str]) -> Iterator[tuple[str, str, str]]:
    types_at, keys_at = unpack_from("<I", chunk, 268)[0], unpack_from("<I", chunk, 276)[0]
    if max(types_at, keys_at) >= len(chunk):
        return
    kinds, keys = pool(chunk[types_at:]), pool(chunk[keys_at:])
    wanted = max((k + 1 for k, name in enumerate(kinds) if name == "string"), default=0)
    for kind, part in chunks(chunk, header(chunk)):
        if wanted and kind == TYPE and len(part) >= 30 and part[8] == wanted and header(part) >= 30:
            yield from _type_strings(part, texts, keys)


def _type_strings(part: memoryview, texts: list[str], keys: list[str]) -> Iterator[tuple[str, str, str]]:
    flags = part[9]
    count, base = unpack_from("<2I", part, 12)
    first = part[28]
    language = "" if not first else "packed" if first & 0x80 else bytes(part[28:30]).decode("latin-1").lower()
    for offset in _offsets(part, flags, count):
        at = base + offset
        if at + 8 > len(part):
            continue
        size, entry_flags = unpack_from("<2H", part, at)
        if entry_flags & COMPACT:
            key, type_, value = size, entry_flags >> 8, unpack_from("<I", part, at + 4)[0]
        elif entry_flags & COMPLEX or at + 16 > len(part):
            continue
        else:
            key, type_, value = unpack_from("<I", part, at + 4)[0], part[at + 11], unpack_from("<I", part, at + 12)[0]
        name = _at(keys, key)
        if type_ == STRING and name:
            yield language, name, _at(texts, value) if not language else ""


def _offsets(part: memoryview, flags: int, count: int) -> Iterator[int]:
    """Offsets of the entries that there are."""
    at = header(part)
    if flags & SPARSE:
        have = min(count, (len(part) - at) // 4)
        yield from (4 * o for _, o in (unpack_from("<2H", part, at + 4 * k) for k in range(have)))
    elif flags & OFFSET16:
        have = min(count, (len(part) - at) // 2)
        yield from (4 * o for o in unpack_from(f"<{have}H", part, at) if o != 0xFFFF)
    else:
        have = min(count, (len(part) - at) // 4)
        yield from (o for o in unpack_from(f"<{have}I", part, at) if o != 0xFFFFFFFF)


_HOST = re.compile(urls.HOST.encode())


def named_hosts(archive: zipfile.ZipFile) -> list[str]:
    """The first MOST_HOSTS distinct hosts in files that can name some, sorted. DEX files name them in their strings, which lie in the file as they are."""
    found: dict[str, None] = {}
    for entry in archive.infolist():
        low = entry.filename.lower()
        base = posixpath.basename(entry.filename)
        dex = base.startswith("classes") and base.endswith(".dex")
        if entry.file_size > LARGEST_FILE or not (dex or posixpath.splitext(low)[1] in HOST_ENDINGS or (low.startswith("lib/") and low.endswith(".so"))):
            continue
        for m in _HOST.finditer(archive.read(entry)):
            host = m[1].decode("ascii").lower()
            if host in urls.SKIPPED_EXACT or host in SKIPPED_HOSTS or any(host == s or host.endswith("." + s) for s in urls.SKIPPED_HOSTS):
                continue
            if len(found) < MOST_HOSTS:
                found[host] = None
    return sorted(found)


_APK = "path string, package string, version string, permissions array<string>, components array<string>, manifest boolean, hosts array<string>, strings array<struct<lang:string,key:string,value:string>>"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, content in zip(batch["path"], batch["content"], strict=True):
            row = {"path": path, "package": "", "version": "", "permissions": [], "components": [], "manifest": False, "hosts": [], "strings": []}
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    names = set(archive.namelist())
                    if "AndroidManifest.xml" in names and (got := elements(archive.read("AndroidManifest.xml"))):
                        row |= signals(archive.read("AndroidManifest.xml")) | {"manifest": bool(got)}
                    if "resources.arsc" in names and archive.getinfo("resources.arsc").file_size <= LARGEST_TABLE:
                        row["strings"] = [dict(zip(("lang", "key", "value"), s, strict=True)) for s in table_strings(archive.read("resources.arsc"))]
                    row["hosts"] = named_hosts(archive)
            except (zipfile.BadZipFile, ValueError, KeyError, OSError):
                pass
            rows.append(row)
        yield pd.DataFrame(rows, columns=["path", "package", "version", "permissions", "components", "manifest", "hosts", "strings"])


def read_packages(spark: SparkSession, path: str, glob: str = "*.apk") -> DataFrame:
    """(path, package, version, permissions, components, manifest, hosts, strings) of the packages below a folder; what can't be read is empty."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInPandas(_read, _APK)


def app_strings(packages: DataFrame, key: str = "path") -> DataFrame:
    """(key, lang, name, value): one row per string of a package."""
    return packages.select(key, F.explode("strings").alias("s")).select(key, "s.lang", F.col("s.key").alias("name"), "s.value")
