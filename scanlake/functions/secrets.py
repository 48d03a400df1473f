"""Secret rules and their match expression. Patterns must hold in Java and RE2."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlake.functions.binding import bound


@dataclass(frozen=True)
class SecretRule:
    """A named pattern tested on single lines; ``group`` holds the secret itself.

    Every match must contain one of ``keywords``, in any case if the pattern starts with
    ``(?i)``; without keywords the pattern runs on every text. Use no look-around, back
    reference or ``\\A``/``\\z``: the pattern also tests whole texts. Repeat single characters
    and classes only: the Java matcher recurses on repeated groups. A pattern that can start
    anywhere in a run of one class needs an edge before it, or long lines take quadratic time.
    """

    name: str
    pattern: str
    group: int = 0
    keywords: tuple[str, ...] = ()


# The published shapes of common credentials. Keys of fixed width end where the
# word ends; all others are as long as they are.
DEFAULT_RULES = (
    SecretRule("AWS", r"((?:AKIA|ASIA)[0-9A-Z]{16})(?:[^0-9A-Za-z_]|$)", 1, ("AKIA", "ASIA")),
    SecretRule(
        "GitHub", r"(gh[pousr]_[0-9A-Za-z]{36})(?:[^0-9A-Za-z_]|$)", 1, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
    ),
    SecretRule("Slack", r"xox[abprs]-[0-9A-Za-z-]{10,}", keywords=("xox",)),
    SecretRule("PrivateKey", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", keywords=("PRIVATE KEY-----",)),
    SecretRule(
        "JWT",
        r"(?:^|[^0-9A-Za-z_-])(eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,})",
        1,
        ("eyJ",),
    ),
    SecretRule("URI", r"[0-9A-Za-z+.-]://[^\s/:@]+:([^\s/:@]+)@", 1, ("://",)),
    SecretRule(
        "Token",
        r"(?i)(?:token|secret|password|api_?key) *[:=] *[\"']?([0-9a-f]{32,})",
        1,
        ("token", "secret", "password", "api_key", "apikey"),
    ),
)


def may_hold(text: Column, rules: Sequence[SecretRule]) -> Column:
    """Whether any rule can match: literal searches first, patterns only where one hits.

    On most texts no pattern runs at all.
    """
    tests = [_may_match(text, rule) for rule in rules]
    return reduce(lambda a, b: a | b, tests)


def _may_match(text: Column, rule: SecretRule) -> Column:
    matches = F.rlike(text, F.lit(f"(?m){rule.pattern}"))
    if not rule.keywords:
        return matches
    if rule.pattern.startswith("(?i)"):
        return bound(F.lower(text), lambda lowered: _has_any(lowered, rule.keywords)) & matches
    return _has_any(text, rule.keywords) & matches


def _has_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(word)) for word in words])


def redact(secret: Column) -> Column:
    """The first four characters, the rest starred."""
    hidden = F.greatest(F.length(secret) - 4, F.lit(0))
    return F.concat(F.left(secret, F.lit(4)), F.repeat(F.lit("*"), hidden))


def find_secrets(text: Column, rules: Sequence[SecretRule] = DEFAULT_RULES) -> Column:
    """Array of (line, secret_type, match) over the whole text, in line and rule order.

    Lines are split only in texts where a rule can match.
    """
    numbered = F.transform(
        F.split(text, "\n"), lambda line, i: F.struct((i + 1).alias("n"), line.alias("text"))
    )
    hits = F.flatten(
        F.transform(
            F.filter(numbered, lambda line: may_hold(line["text"], rules)),
            lambda line: F.concat(*[_rule_hits(line, rule) for rule in rules]),
        )
    )
    none = F.array().cast("array<struct<line:int,secret_type:string,match:string>>")
    return F.when(may_hold(text, rules), hits).otherwise(none)


def _rule_hits(line: Column, rule: SecretRule) -> Column:
    found = F.regexp_extract_all(line["text"], F.lit(rule.pattern), F.lit(rule.group))
    return F.transform(
        found,
        lambda match: F.struct(
            line["n"].alias("line"), F.lit(rule.name).alias("secret_type"), match.alias("match")
        ),
    )
