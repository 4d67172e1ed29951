"""URL expressions that take any text: parts are found by pattern, since strict parsers give null for odd addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters that only track.
TRACKING = ("fbclid", "gclid")


def _tracking(key: Column) -> Column:
    return F.startswith(F.lower(key), F.lit("utm_")) | F.lower(key).isin(*TRACKING)


def _decoded(part: Column) -> Column:
    """The decoded part; a percent sign that begins no escape stands for itself."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25")), part)


def _encoded(part: Column) -> Column:
    """As form encoding writes it: a star is escaped, a tilde is not."""
    return F.replace(F.replace(F.url_encode(part), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def strip_tracking(url: Column) -> Column:
    """The address without tracking parameters. Values of a repeated key stand together where the key first stood."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    head, fragment = F.regexp_extract(url, r"^[^?#]*", 0), F.regexp_extract(url, r"#.*$", 0)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    split = F.transform(pairs, lambda p: F.struct(_decoded(F.regexp_extract(p, "^[^=]*", 0)).alias("k"), _decoded(F.regexp_extract(p, "=(.*)$", 1)).alias("v")))
    kept = F.filter(split, lambda p: ~_tracking(p["k"]))
    keys = F.array_distinct(F.transform(kept, lambda p: p["k"]))
    grouped = F.flatten(F.transform(keys, lambda k: F.filter(kept, lambda p: p["k"] == k)))
    new = F.array_join(F.transform(grouped, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    return F.when(query == "", url).otherwise(F.concat(head, F.when(new != "", F.concat(F.lit("?"), new)).otherwise(F.lit("")), fragment))


def resolve_url(url: Column) -> Column:
    """The address behind reader-mode wrappers and escaped separators, without tracking parameters."""
    x = F.trim(url)
    inner = _decoded(F.nullif(F.regexp_extract(x, r"[?&]url=([^&#]*)", 1), F.lit("")))
    plain = F.when(F.contains(x, F.lit("seismic.com")), F.replace(F.replace(x, F.lit("PLUSSIGN"), F.lit("+")), F.lit("___"), F.lit("/"))).otherwise(x)
    return F.when(F.startswith(x, F.lit("read://")) & inner.isNotNull(), strip_tracking(inner)).otherwise(strip_tracking(plain))


def source_type(url: Column) -> Column:
    path = F.regexp_replace(F.regexp_extract(url, r"^[^?#]*", 0), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.when(F.endswith(F.lower(path), F.lit(".pdf")), "pdf").otherwise("html")
