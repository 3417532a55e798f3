"""URLs and HTML heads."""

from __future__ import annotations

import html
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions import text as tx

# Hosts that say nothing about an app, as they are and with all their subdomains.
SKIPPED_EXACT = ("localhost", "127.0.0.1", "0.0.0.0", "example.com", "www.example.com", "example.org", "www.example.org", "schema.org", "w3.org", "www.w3.org", "github.com", "www.github.com", "gitlab.com", "codeberg.org", "xmlpull.org", "schemas.android.com", "www.apache.org", "apache.org", "pub.dev", "golang.org", "proxy.golang.org")
SKIPPED_HOSTS = ("schemas.android.com", "xml.org", "xmlns.jcp.org", "apache.org", "w3.org", "example.com", "example.org")
HOST = r"https?://([A-Za-z0-9._-]+)"
META_KEYS = ("description", "og:description", "twitter:description")
TITLE_KEYS = ("og:title", "twitter:title")


def hosts(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(HOST), 1)


def skipped_host(h: Column) -> Column:
    return F.lower(h).isin(*SKIPPED_EXACT) | F.lower(h).rlike(r"(^|\.)(" + "|".join(s.replace(".", r"\.") for s in SKIPPED_HOSTS) + r")\z")


# Fixed values (RE2): addresses of networks that aren't public, in their plain forms.
LOCAL_V4 = r"^(?:0|10|127)\.|^169\.254\.|^192\.168\.|^172\.(?:1[6-9]|2[0-9]|3[01])\.|^(?:22[4-9]|23[0-9])\."
LOCAL_V6 = r"^\[(?:::1?|f[cd][0-9a-f:.]*|fe[89ab][0-9a-f:.]*|ff[0-9a-f:.]*|::ffff:.*)\]$"


def public_https(url: Column) -> Column:
    """https, no user part, a host that isn't local by name or plain address. What a name resolves to is asked by whoever fetches."""
    authority = F.regexp_extract(url, r"(?i)^https://([^/?#\s]*)(?:[/?#]\S*)?\z", 1)
    host = F.lower(F.regexp_replace(authority, r":[0-9]*\z", ""))
    local = host.isin("", "localhost", "::") | host.endswith(".localhost") | host.rlike(LOCAL_V4) | host.rlike(LOCAL_V6) | ~host.rlike(r"^\[[0-9a-f:.]+\]\z|^[a-z0-9._-]+\z") | host.rlike(r"^(?:0x[0-9a-f]+|[0-9]+)\z")
    return (authority != "") & ~F.contains(authority, F.lit("@")) & ~local


def head(page: Column) -> Column:
    """What comes before </head>, or the whole page."""
    return F.split(page, r"(?i)</head>", 2)[0]


def raw_title(page: Column) -> Column:
    """Text of the first <title> of the head, as it stands; empty if none."""
    return F.trim(F.regexp_extract(head(page), r"(?is)<title[^>]*>(.*?)</title>", 1))


@F.pandas_udf(T.StringType())
def unescape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for x in batches:
        yield x.map(html.unescape, na_action="ignore")


# Bytes of a description and of a title.
MOST_TEXT, MOST_TITLE = 1000, 200


def clean(x: Column, most: int) -> Column:
    """Entities read, white space collapsed, clipped to bytes, broken characters dropped."""
    return tx.clip_bytes_valid(tx.one_line(unescape(x)), most)


_ATTRIBUTE = r"""(?is)([a-z:-]+)\s*=\s*("[^"]*"|'[^']*')"""


def metas(page: Column) -> Column:
    """Array of (key, content) of the head's meta tags, keys lower-case, the first 200; of repeated attributes the last counts."""
    tags = F.slice(F.regexp_extract_all(head(page), F.lit(r"(?is)<meta\s[^>]*>"), 0), 1, 200)

    def read(tag: Column) -> Column:
        all_ = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), 0)
        pairs = F.transform(all_, lambda a: F.struct(F.lower(F.regexp_extract(a, r"(?is)^[a-z:-]+", 0)).alias("name"), F.regexp_extract(a, r"(?s)=\s*.(.*).\z", 1).alias("value")))
        last = lambda *names: F.coalesce(F.try_element_at(F.filter(pairs, lambda p: p["name"].isin(*names)), F.lit(-1))["value"], F.lit(""))
        return F.struct(F.lower(F.trim(last("name", "property"))).alias("key"), F.trim(last("content")).alias("content"))

    return F.transform(tags, read)


def first_meta(page: Column, keys: tuple[str, ...]) -> Column:
    """First non-empty content by precedence of keys; null if none."""
    found = metas(page)

    def one(key: str) -> Column:
        held = F.filter(found, lambda m: (m["key"] == key) & (m["content"] != ""))
        return F.get(held, F.lit(0))["content"]

    return F.coalesce(*[one(k) for k in keys])


def page_meta(page: Column) -> Column:
    """Struct (title, description) of a page: clean, empty where there is none."""
    return F.struct(F.coalesce(clean(raw_title(page), MOST_TITLE), F.lit("")).alias("title"), F.coalesce(clean(first_meta(page, META_KEYS), MOST_TEXT), F.lit("")).alias("description"))
