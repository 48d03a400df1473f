"""Expressions over the nested arrays of scan records; none of them shuffles."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlake.functions.binding import bound

SEVERITIES = ("critical", "high", "medium", "low")


def first_severity(severity: Column) -> Column:
    """Score of the first severity entry, else the empty text."""
    return F.coalesce(F.get(severity, F.lit(0))["score"], F.lit(""))


def first_cve(aliases: Column) -> Column:
    """First alias that starts with CVE and has more after it, else the empty text."""
    named = F.filter(aliases, lambda a: F.startswith(a, F.lit("CVE")) & (F.octet_length(a) > 3))
    return F.coalesce(F.get(named, F.lit(0)), F.lit(""))


def severity_level(severity: Column, band_scores: bool = False) -> Column:
    """critical, high, medium, low or unknown, ignoring case.

    A numeric score is unknown unless ``band_scores`` maps it by the CVSS v3 bands.
    """
    word = F.upper(severity)
    level = F.when(word.isin(*[name.upper() for name in SEVERITIES]), F.lower(word))
    if band_scores:
        score = severity.try_cast("double")
        # Lower bounds of the public CVSS v3 severity bands.
        for name, low in zip(SEVERITIES, (9.0, 7.0, 4.0, 0.1)):
            level = level.when(score >= low, name)
    return level.otherwise("unknown")


def severity_counts(vulnerabilities: Column, band_scores: bool = False) -> Column:
    """Struct of the five counts over an array of vulnerabilities; a null array counts 0."""
    levels = F.coalesce(
        F.transform(vulnerabilities, lambda v: severity_level(v["severity"], band_scores)),
        F.array().cast("array<string>"),
    )
    return bound(
        levels,
        lambda found: F.struct(
            *[_occurrences(found, name).alias(f"{name}_count") for name in (*SEVERITIES, "unknown")]
        ),
    )


def _occurrences(words: Column, word: str) -> Column:
    return F.size(words) - F.size(F.array_remove(words, word))


def scan_status(
    kind: str, count: Column, error: Column | None = None, timed_out: Column | None = None
) -> Column:
    """Status of one scan: timeout, failed, no_secrets / no_vulnerabilities, success.

    ``timed_out`` always gives timeout, also for a scan cut off with partial findings.
    """
    if kind not in ("secrets", "vulnerabilities"):
        raise ValueError(f"unknown scan kind: {kind}")
    done = F.when(F.coalesce(count, F.lit(0)) == 0, f"no_{kind}").otherwise("success")
    if error is not None:
        done = F.when(F.coalesce(error, F.lit("")) != "", "failed").otherwise(done)
    if timed_out is not None:
        done = F.when(F.coalesce(timed_out, F.lit(False)), "timeout").otherwise(done)
    return done
