"""Paths, URLs and document ids."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def clean_path(path: Column) -> Column:
    """Lexical cleaning: no ``//``, ``.`` or resolvable ``..``; the empty path is ``.``."""
    rooted = F.startswith(path, F.lit("/"))
    parts = F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(
            (p == "..") & (F.size(acc) > 0) & ~F.try_element_at(acc, F.lit(-1)).eqNullSafe(".."),
            F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
        )
        .when((p == "..") & rooted, acc)
        .otherwise(F.array_append(acc, p)),
    )
    joined = F.array_join(kept, "/")
    cleaned = F.when(rooted, F.concat(F.lit("/"), joined)).when(joined == "", ".").otherwise(joined)
    # Most paths are clean already; a search tells without splitting them.
    clean = rooted & ~F.rlike(path, F.lit(r"//|/\.{1,2}(?:/|$)|/$"))
    return F.when(clean, path).otherwise(cleaned)


def absolute_path(path: Column, cwd: str = "/") -> Column:
    """Cleaned path; a relative one is taken from ``cwd``."""
    return clean_path(
        F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat_ws("/", F.lit(cwd), path))
    )


def path_is_within(path: Column, root, cwd: str = "/", prefix_only: bool = False) -> Column:
    """Whether the cleaned path lies below the cleaned root.

    ``prefix_only`` compares text prefixes alone, which also accepts the root itself and a
    sibling such as ``/a/b-evil`` for ``/a/b``.
    """
    full, base = absolute_path(path, cwd), absolute_path(_as_column(root), cwd)
    if prefix_only:
        return F.startswith(full, base)
    folder = F.when(base == "/", base).otherwise(F.concat(base, F.lit("/")))
    return F.startswith(full, folder) & (full != base)


def work_path(folder, org: Column, name: Column, unique: Column | None = None) -> Column:
    """``folder/org_name_<32 hex>``; pass ``unique`` for a reproducible suffix."""
    suffix = F.replace(F.uuid(), F.lit("-"), F.lit("")) if unique is None else unique
    return clean_path(
        F.concat_ws("/", _as_column(folder), F.concat_ws("_", org, name, suffix))
    )


def repo_url(org: Column, name: Column, host: str = "https://github.com") -> Column:
    """Clone URL of a repository."""
    return F.concat(F.lit(f"{host}/"), org, F.lit("/"), name, F.lit(".git"))


def finding_id(org: Column, name: Column, commit: Column, line: Column, idx: Column) -> Column:
    """Id of a finding document; idx counts from 0 inside one scan."""
    return F.concat_ws("_", org, name, commit, line.cast("string"), idx.cast("string"))


def summary_id(org: Column, name: Column, scanned_at: Column) -> Column:
    """Id of the document written for a scan without findings."""
    return F.concat_ws("_", org, name, F.lit("summary"), _epoch(scanned_at))


def vulnerability_id(org: Column, name: Column, scanned_at: Column) -> Column:
    """Id of the one vulnerability document of a scan."""
    return F.concat_ws("_", org, name, F.lit("osv"), _epoch(scanned_at))


def _epoch(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp")).cast("string")
