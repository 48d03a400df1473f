"""Findings: scanner output, secret detection, dependency matches, scan records."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake import schemas
from scanlake.functions import nested
from scanlake.functions.binding import bound
from scanlake.functions.secrets import DEFAULT_RULES, SecretRule, find_secrets, may_hold, redact
from scanlake.sources.records import decode_records, record_array

# Fixed value: output lines of this size fail a line-buffered reader.
MAX_LINE_BYTES = 64 * 1024


def split_lines(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Non-empty lines of a text column as (keep..., line_no from 1, value)."""
    lines = df.select(*keep, F.posexplode(F.split(value, "\n")).alias("line_no", "value"))
    return lines.filter("value <> ''").withColumn("line_no", F.col("line_no") + 1)


def parse_secret_lines(
    df: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Findings from secret-scanner output, one JSON object per line.

    Empty and malformed lines are skipped. Lines of any length are read; a line-buffered
    reader fails on 64 KiB, and ``oversize_lines`` lists the lines it would fail on.
    """
    lines = split_lines(df, value, keep)
    raw = decode_records(lines, schemas.RAW_SECRET, keep=(*keep, "line_no"))
    return raw.select(*keep, "line_no", *_finding_fields(F.col))


def secret_array(output: Column) -> Column:
    """The same findings as one array inside the row, for building scan records."""
    lines = F.filter(F.split(output, "\n"), lambda line: line != "")
    return F.flatten(
        F.transform(
            lines,
            lambda line: F.transform(
                record_array(line, schemas.RAW_SECRET),
                lambda raw: F.struct(*_finding_fields(lambda name: raw[name])),
            ),
        )
    )


def _finding_fields(field: Callable[[str], Column]) -> list[Column]:
    git, error = field("SourceMetadata")["Data"]["Git"], field("VerificationError")
    service = F.when(error != "", F.concat(F.lit("verification_error: "), error)).otherwise("")
    return [
        field("DetectorName").alias("secret_type"),
        F.concat(F.lit("Found "), field("DetectorName"), F.lit(" secret")).alias("description"),
        git["file"].alias("file"),
        git["line"].alias("line"),
        git["commit"].alias("commit"),
        F.lit("high").alias("confidence"),
        field("Verified").alias("validated"),
        service.alias("service"),
    ]


def oversize_lines(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Lines of 64 KiB or more: (keep..., line_no, bytes)."""
    lines = split_lines(df, value, keep).withColumn("bytes", F.octet_length("value"))
    return lines.filter(F.col("bytes") >= MAX_LINE_BYTES).drop("value")


def flatten_vulnerabilities(
    df: DataFrame, results: str = "results", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per result, package and vulnerability, with its position at each level.

    Ordering by (result_no, package_no, vulnerability_no) restores the report's order;
    empty levels give no row.
    """
    step = df.select(*keep, F.posexplode(results).alias("result_no", "r"))
    step = step.select(
        *keep, "result_no", F.col("r.source.path").alias("path"),
        F.posexplode("r.packages").alias("package_no", "p"),
    )
    step = step.select(
        *keep, "result_no", "package_no", "path", F.col("p.package").alias("package"),
        F.posexplode("p.vulnerabilities").alias("vulnerability_no", "v"),
    )
    return step.select(
        *keep, "result_no", "package_no", "vulnerability_no",
        F.col("v.id").alias("id"),
        F.col("package.name").alias("package"),
        F.col("package.version").alias("version"),
        F.col("package.ecosystem").alias("ecosystem"),
        nested.first_severity(F.col("v.severity")).alias("severity"),
        F.col("v.summary").alias("summary"),
        F.col("v.details").alias("details"),
        F.col("v.aliases").alias("aliases"),
        F.lit("").alias("fixed"),
        nested.first_cve(F.col("v.aliases")).alias("cve"),
        F.col("v.cwe").alias("cwe"),
        F.col("path").alias("package_file"),
    )


def vulnerability_array(results: Column) -> Column:
    """The same findings as one array inside the row, for building scan records."""
    return F.flatten(F.transform(results, _result_findings))


def _result_findings(result: Column) -> Column:
    return F.flatten(
        F.transform(
            result["packages"],
            lambda p: F.transform(
                p["vulnerabilities"],
                lambda v: F.struct(
                    v["id"].alias("id"),
                    p["package"]["name"].alias("package"),
                    p["package"]["version"].alias("version"),
                    p["package"]["ecosystem"].alias("ecosystem"),
                    nested.first_severity(v["severity"]).alias("severity"),
                    v["summary"].alias("summary"),
                    v["details"].alias("details"),
                    v["aliases"].alias("aliases"),
                    F.lit("").alias("fixed"),
                    nested.first_cve(v["aliases"]).alias("cve"),
                    v["cwe"].alias("cwe"),
                    result["source"]["path"].alias("package_file"),
                ),
            ),
        )
    )


def scan_records(
    scans: DataFrame,
    kind: str,
    findings: Column,
    error: Column | None = None,
    timed_out: Column | None = None,
) -> DataFrame:
    """Scan records from (org, name, processed_at, scanned_at, worker_id, scan_duration).

    A failed scan keeps its error and has no findings.
    """
    schema = schemas.SECRET_SCAN if kind == "secrets" else schemas.VULNERABILITY_SCAN
    count_field, items_field = schema.names[5], schema.names[6]
    message = F.coalesce(error, F.lit("")) if error is not None else F.lit("")
    items = F.coalesce(findings, F.array()).cast(schema[items_field].dataType)
    empty = F.array().cast(schema[items_field].dataType)
    built = scans.withColumn("error_message", message).withColumn(
        items_field, F.when(F.col("error_message") == "", items).otherwise(empty)
    )
    size = F.size(items_field)
    status = nested.scan_status(kind, size, F.col("error_message"), timed_out)
    built = built.withColumn("scan_status", status).withColumn(count_field, size)
    return built.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def detect_secrets(
    docs: DataFrame,
    rules: Sequence[SecretRule] = DEFAULT_RULES,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    verified: DataFrame | None = None,
    only_verified: bool = False,
) -> DataFrame:
    """Secrets in whole texts: (keep..., finding_no, line, secret_type, match, redacted, validated).

    ``verified`` is a table of ``match_hash`` (SHA-256 in hex); a finding is validated when
    its hash is listed. Lines are never shuffled: one scan, one filter, one explode; only
    findings meet the hash table.
    """
    hits = docs.filter(may_hold(F.col(text), rules)).select(
        *keep, F.posexplode(find_secrets(F.col(text), rules)).alias("finding_no", "f")
    )
    found = hits.select(
        *keep,
        "finding_no",
        "f.line",
        "f.secret_type",
        "f.match",
        redact(F.col("f.match")).alias("redacted"),
    )
    if verified is None:
        flagged = found.withColumn("validated", F.lit(False))
    else:
        known = verified.select(F.col("match_hash").alias("_known")).distinct()
        flagged = found.join(known, F.sha2("match", 256) == F.col("_known"), "left")
        flagged = flagged.withColumn("validated", F.col("_known").isNotNull()).drop("_known")
    return flagged.filter("validated") if only_verified else flagged


# How the words of Python version suffixes sort; "2" is a release.
_PHASES = {
    "dev": "", "a": "1a", "alpha": "1a", "b": "1b", "beta": "1b", "c": "1rc", "rc": "1rc", "pre": "1rc",
    "preview": "1rc", "post": "3", "rev": "3", "r": "3",
}
_MARK = "\x01"
_VERSION = (
    r"^\s*[vV=]?(?:([0-9]+)!)?([0-9][0-9.]*)"
    r"(?:-([0-9A-Za-z.-]+)|[._-]?((?i)dev|alpha|a|beta|b|rc|c|preview|pre|post|rev|r)[._-]?([0-9]*))?"
    r"(?:\+[0-9A-Za-z.-]*)?\s*$"
)


def _number(digits: Column) -> Column:
    """A text that sorts as the number does, whatever its length."""
    # Of zeros alone one stays.
    plain = F.coalesce(F.nullif(F.ltrim(digits, F.lit("0")), F.lit("")), F.left(digits, F.lit(1)))
    return F.concat(F.lpad(F.length(plain), 10, "0"), plain)


def version_key(version: Column) -> Column:
    """Comparable form of a version; null for a text that is none.

    Release numbers of any length, an epoch, pre-release identifiers in their semantic order
    (so also pseudo versions of untagged commits) and the suffixes dev, a, b, rc and post. A
    leading v, zeros at the end and build metadata do not count: v1.2.0, 1.2 and 1.2+x are
    one version.
    """
    # One search gives all groups; a text that matches holds no mark.
    groups = "".join(f"{_MARK}${i}" for i in range(1, 6))
    return bound(F.split(F.when(~F.contains(version, F.lit(_MARK)), F.regexp_replace(version, _VERSION, groups)), _MARK), _key_of_groups)


def _key_of_groups(parts: Column) -> Column:
    """The key of the groups of ``_VERSION`` behind an empty text; null for a text that did not match."""
    epoch, release, identifiers, word, count = [F.get(parts, F.lit(i)) for i in range(1, 6)]
    names = F.transform(
        F.split(identifiers, r"\."),
        lambda x: F.when(F.rlike(x, F.lit("^[0-9]+$")), F.concat(F.lit("0"), _number(x))).otherwise(
            F.concat(F.lit("1"), x)
        ),
    )
    words = F.create_map(*[F.lit(x) for pair in _PHASES.items() for x in pair])
    suffix = F.array(words[F.lower(word)], _number(F.when(count == "", "0").otherwise(count)))
    phase = F.when(identifiers != "", names).when(word != "", suffix).otherwise(F.array(F.lit("2")))
    empty_part = F.contains(release, F.lit("..")) | (F.endswith(release, F.lit(".")) & (word == ""))
    empty_name = F.rlike(identifiers, F.lit(r"^\.|\.\.|\.$"))
    kept = bound(F.transform(F.split(F.rtrim(release, F.lit(".")), r"\."), _number), _without_zeros)
    key = F.struct(
        _number(F.when(epoch == "", "0").otherwise(epoch)).alias("epoch"), kept.alias("release"), phase.alias("phase")
    )
    return F.when((release != "") & ~empty_part & ~empty_name, key)


def _without_zeros(numbers: Column) -> Column:
    """The numbers up to the last that is not zero; the first one stays."""
    last = F.array_position(F.transform(F.reverse(numbers), lambda x: x != F.lit("00000000010")), True)
    return F.when(last == 0, F.slice(numbers, 1, 1)).otherwise(
        F.slice(numbers, F.lit(1), (F.size(numbers) - last + 1).cast("int"))
    )


def with_version_key(df: DataFrame, version: str = "version", key: str = "_key") -> DataFrame:
    """``df`` with the comparable form of its versions, without the rows whose version has no known order.

    As a generated column the key is made once for each row: a filter on it would be copied below, and to
    the other side of a join.
    """
    return df.select("*", F.explode(F.array_compact(F.array(version_key(F.col(version))))).alias(key))


def unread_versions(df: DataFrame, version: str = "version") -> DataFrame:
    """Rows whose version has no known order, unchanged: ``match_vulnerabilities`` cannot compare them."""
    return df.filter(version_key(F.col(version)).isNull())


def match_vulnerabilities(deps: DataFrame, advisories: DataFrame) -> DataFrame:
    """Dependencies with introduced <= version < fixed of an advisory for their package.

    deps: ecosystem, package, version and any other columns; advisories: ecosystem,
    package, introduced ('' or '0' = every version), fixed ('' = not fixed) and any other
    columns. Versions of no known order match nothing and are listed by ``unread_versions``.

    Each distinct (ecosystem, package, version) is read and compared once, however many inventories
    hold it; the matches then join back. Both joins sort: built from a few numbers of a small file, a table can
    be many times the size that Spark expects and broadcasts. Skewed partitions of the big side are split.
    """
    coordinates = ["ecosystem", "package", "version"]
    extra = [name for name in advisories.columns if name not in ("ecosystem", "package")]
    # Ranges come from few files and are read by all tasks.
    spread = advisories.repartition("ecosystem", "package", "introduced", "fixed")
    ranges = spread.withColumn("_low", version_key(F.col("introduced"))).withColumn(
        "_high", version_key(F.col("fixed"))
    )
    versions = with_version_key(deps.select(*coordinates).distinct())
    inside = (F.col("introduced").isin("", "0") | (F.col("_low") <= F.col("_key"))) & (
        (F.col("fixed") == "") | (F.col("_key") < F.col("_high"))
    )
    # Inside coalesce no "is not null" is inferred and run on every dependency first.
    affected = versions.join(ranges.hint("merge"), ["ecosystem", "package"]).filter(F.coalesce(inside, F.lit(False)))
    return deps.join(affected.select(*coordinates, *extra).hint("merge"), coordinates)
