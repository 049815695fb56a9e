"""Names, identifiers, paths and hrefs as Column expressions (all inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public object-store prefix that becomes an s3 uri, and the display text of the table suffix.
HTTP_STORE_PREFIX = "https://storage.googleapis.com/"
TABLE_SUFFIX = "__tab"
TABLE_SUFFIX_LABEL = " (tabla)"
MAX_PACKAGE_SLUG = 80


def slug(name: Column, flavour: str = "layer") -> Column:
    """Identifier from a free name.

    ``layer`` uses the part after the last colon, ``package`` is cut to 80 characters after the
    underscores are stripped, ``coverage`` takes the whole text.
    """
    if flavour not in ("layer", "package", "coverage"):
        raise ValueError(f"unknown slug flavour {flavour!r}")
    text = F.substring_index(name, ":", -1) if flavour == "layer" else name
    text = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.substring(text, 1, MAX_PACKAGE_SLUG) if flavour == "package" else text


def package_theme(groups: Column) -> Column:
    """First group, or ``OpenData`` when there is none."""
    first = F.try_element_at(groups, F.lit(1))
    return F.when(F.size(groups) > 0, first).otherwise(F.lit("OpenData"))


def coverage_theme(coverage_id: Column) -> Column:
    """Text before the first double underscore, or ``raster``."""
    return F.when(coverage_id.contains("__"), F.substring_index(coverage_id, "__", 1)).otherwise(F.lit("raster"))


def layer_theme(workspace: Column) -> Column:
    return workspace


def humanise(identifier: Column) -> Column:
    """Display name: suffix label, spaces for underscores, capital at the start of every ASCII word."""
    labelled = F.regexp_replace(identifier, f"{TABLE_SUFFIX}$", TABLE_SUFFIX_LABEL)
    spaced = F.translate(labelled, "_", " ")
    pieces = F.split(spaced, "(?<![A-Za-z0-9])(?=[A-Za-z0-9])")
    capital = F.transform(
        pieces,
        lambda p: F.when(
            p.rlike("^[a-z]"), F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))
        ).otherwise(p),
    )
    return F.array_join(capital, "")


def safe_table_name(identifier: Column) -> Column:
    """Every character that is not an ASCII letter, digit or underscore becomes one underscore."""
    return F.regexp_replace(identifier, "[^A-Za-z0-9_]", "_")


def s3_uri(url: Column) -> Column:
    """First occurrence of the public http prefix becomes ``s3://``."""
    at = F.instr(url, HTTP_STORE_PREFIX)
    swapped = F.concat(
        F.substring(url, F.lit(1), at - 1), F.lit("s3://"), F.substring(url, at + len(HTTP_STORE_PREFIX), F.length(url))
    )
    return F.when(at > 0, swapped).otherwise(url)


def data_path(identifier: Column, given: Column | None = None) -> Column:
    built = F.concat(F.lit("v3/"), identifier, F.lit("/data/"), identifier, F.lit(".parquet"))
    return built if given is None else F.coalesce(given, built)


def metadata_path(identifier: Column, given: Column | None = None) -> Column:
    built = F.concat(F.lit("v3/"), identifier, F.lit("/metadata/v1.metadata.json"))
    return built if given is None else F.coalesce(given, built)


def dataset_path(base: str | Column, path: Column) -> Column:
    """Public base plus key."""
    prefix = F.lit(base) if isinstance(base, str) else base
    return F.concat(prefix, F.lit("/"), path)


def classify_by_href(href: Column) -> Column:
    """Dataset kind from its data href. Raster is decided on the path, remote on the scheme."""
    return (
        F.when(href.startswith("v2.") | href.startswith("v3."), F.lit("vector"))
        .when(href.startswith("tab."), F.lit("non-geo"))
        .when(href.rlike("/data/raster/.*\\.parquet$"), F.lit("raster"))
        .when(href.startswith("s3://"), F.lit("remote"))
    )


def dataset_id_from_path(path: Column) -> Column:
    """Last path part of a ``.parquet`` file or folder, without the ending."""
    return F.nullif(F.regexp_extract(path, "([^/]+)\\.parquet$", 1), F.lit(""))
