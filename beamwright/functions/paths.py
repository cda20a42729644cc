"""Path functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rel_path(path: Column) -> Column:
    """The piece between the first and second ``/global``, one leading slash removed."""
    return F.regexp_replace(F.get(F.split(path, "/global"), 1), "^/", "")


def full_path(root: Column, suffix: Column) -> Column:
    base = F.rtrim(root, F.lit("/"))
    rest = F.ltrim(F.coalesce(suffix, F.lit("")), F.lit("/"))
    bare = F.when(base == "", F.lit("/")).otherwise(base)
    return F.when(rest == "", bare).otherwise(F.concat(base, F.lit("/"), rest))


def storage_path(path: Column, source_root: str, storage_root: str) -> Column:
    return F.replace(path, F.lit(source_root), F.lit(storage_root))


def _tidy(path: Column) -> Column:
    """No double and no trailing slashes."""
    one = F.when(path.contains("//"), F.regexp_replace(path, "/+", "/")).otherwise(path)
    return F.rtrim(one, F.lit("/"))


def base_name(path: Column) -> Column:
    return F.substring_index(_tidy(path), "/", -1)


def parent_name(path: Column) -> Column:
    p = _tidy(path)
    return F.when(p.contains("/"), F.substring_index(F.substring_index(p, "/", -2), "/", 1)).otherwise(F.lit(""))


def parent_dir(path: Column) -> Column:
    """Folder part; empty for a bare name."""
    p = _tidy(path)
    return F.substring(p, F.lit(1), F.length(p) - F.length(F.substring_index(p, "/", -1)) - 1)


def stem(path: Column) -> Column:
    """Base name without its last suffix; a leading dot starts no suffix."""
    name = base_name(path)
    suffix = F.substring_index(name, ".", -1)
    dot = F.length(name) - F.length(suffix)
    return F.when((dot > 1) & (suffix != ""), F.substring(name, F.lit(1), dot - 1)).otherwise(name)


def recon_paths(path: Column) -> Column:
    """All paths a scan file gives rise to."""
    return recon_paths_of(parent_name(path), stem(path))


def recon_paths_of(folder: Column, s: Column) -> Column:
    """The same from a folder name and stem that are columns already."""
    out = F.concat(folder, F.lit("/rec"), s)
    return F.struct(
        s.alias("stem"),
        folder.alias("folder"),
        F.concat(folder, F.lit("/"), s, F.lit(".h5")).alias("raw_path"),
        F.concat(out, F.lit("/")).alias("tiff_path"),
        F.concat(out, F.lit(".zarr/")).alias("zarr_path"),
        out.alias("tiff_path_bare"),
        F.concat(out, F.lit(".zarr")).alias("zarr_path_bare"),
        s.alias("label"),
    )


def parse_scan_name(folder: Column, file: Column) -> Column:
    """``<prefix>-<5 digits>_<user>`` / ``<date>_<time>_<label>[_x##y##].h5``."""
    fold = r"^([^-/]+-\d{5})_(.+)$"
    name = r"^(\d{8}_\d{6})_(.*?)(?:_x(\d{2})y(\d{2}))?\.h5$"

    def part(col, pattern, i):
        return F.nullif(F.regexp_extract(col, pattern, i), F.lit(""))

    return F.struct(
        part(folder, fold, 1).alias("proposal"),
        part(folder, fold, 2).alias("user"),
        F.try_to_timestamp(part(file, name, 1), F.lit("yyyyMMdd_HHmmss")).alias("acquired_at"),
        part(file, name, 2).alias("label"),
        part(file, name, 3).cast("int").alias("tile_x"),
        part(file, name, 4).cast("int").alias("tile_y"),
    )


def prune_run_name(location: Column, path: Column) -> Column:
    return F.concat(F.lit("delete "), location, F.lit(": "), base_name(path))


def prune_key(location: Column) -> Column:
    name = F.concat(F.lit("prune_"), location)
    return F.concat(name, F.lit("/"), name)


def ancestors(path: Column) -> Column:
    """Every folder above a relative path, nearest last."""
    parts = F.split(path, "/")
    return F.transform(
        F.filter(F.sequence(F.lit(1), F.size(parts)), lambda i: i < F.size(parts)),
        lambda i: F.array_join(F.slice(parts, 1, i), "/"),
    )


def visible(name: Column) -> Column:
    return ~name.startswith(".")


def classify_frame(name: Column) -> Column:
    """struct(kind, idx, grp) from a frame name's ending; kind is null when unknown."""
    bright = F.regexp_extract(name, r"bak_(\d{4})(?:_(\d{4}))?\.tif$", 0) != ""
    dark = F.regexp_extract(name, r"drk_(\d{4})(?:_(\d{4}))?\.tif$", 0) != ""
    tomo = F.regexp_extract(name, r"_\d{4}_\d{4}\.tif$", 0) != ""

    def number(pattern):
        return F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")).cast("int")

    side = r"(?:bak|drk)_(\d{4})"
    return F.struct(
        F.when(bright, "flat").when(dark, "dark").when(tomo, "tomo").alias("kind"),
        F.when(bright | dark, number(side)).otherwise(number(r"_\d{4}_(\d{4})\.tif$")).alias("idx"),
        F.when(bright | dark, number(r"(?:bak|drk)_\d{4}_(\d{4})\.tif$"))
        .otherwise(number(r"_(\d{4})_\d{4}\.tif$")).alias("grp"),
    )
