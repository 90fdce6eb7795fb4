"""Rules on text, as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.anchors import matches

# Patterns of secrets. The last one ignores case and takes Unicode's white space and case folding.
PRIVATE_KEY = r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----"
GH_TOKEN = r"\bgh[pousr]_[A-Za-z0-9_]{30,}\b"
GH_PAT = r"\bgithub_pat_[A-Za-z0-9_]{20,}\b"
GOOGLE_KEY = r"\bAIza[0-9A-Za-z_-]{30,}\b"
ASSIGNED = r"""(?iuU)\b(?:api[_-]?key|access[_-]?token|refresh[_-]?token|password)\s*[=:]\s*['"][^'"]{8,}['"]"""
SECRETS = (PRIVATE_KEY, GH_TOKEN, GH_PAT, GOOGLE_KEY, ASSIGNED)

URL = r"https?://[^\s\"'<>)\]]+"
# What no log may hold: authorisation headers, cookies, query strings, values that are assigned to secret names.
SANITIZERS = (
    (r"(?i)\b(authorization|proxy-authorization)\s*:\s*[^\r\n]*", "$1: [removed]"),
    (r"(?i)\b(set-cookie|cookie)\s*:\s*[^\r\n]*", "$1: [removed]"),
    (r"(?i)\b(bearer|basic)\s+[A-Za-z0-9._~+/=-]{8,}", "$1 [removed]"),
    (r"(https?://[^\s?#\"']+)\?[^\s\"']*", "$1?[removed]"),
    (r"(?i)\b(api[_-]?key|access[_-]?token|refresh[_-]?token|password|secret|token)(\s*[=:]\s*)(\"[^\"]*\"|'[^']*'|[^\s,;]+)", "$1$2[removed]"),
)


def has_private_key(text: Column) -> Column:
    return text.rlike(PRIVATE_KEY)


def has_gh_token(text: Column) -> Column:
    return text.rlike(GH_TOKEN)


def has_gh_pat(text: Column) -> Column:
    return text.rlike(GH_PAT)


def has_google_key(text: Column) -> Column:
    return text.rlike(GOOGLE_KEY)


def has_assigned_secret(text: Column) -> Column:
    """A secret's name, = or :, and a quoted value of eight or more; the quotes need not match, and the value may span lines."""
    return text.rlike(ASSIGNED)


def any_pattern(text: Column, patterns: Sequence[str] = SECRETS) -> Column:
    """Whether any pattern is found; the first one found ends the search. Null text holds nothing.

    A pattern is tried only on texts that hold the literals which all its matches hold.
    """
    out = F.lit(False)
    for p in reversed(patterns):
        out = F.when(matches(text, p), F.lit(True)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def message(rule: str | Column, path: Column) -> Column:
    """A finding names rule and path, never what was matched."""
    return F.concat(F.lit(rule) if isinstance(rule, str) else rule, F.lit(": "), path)


def find_links(text: Column, pattern: str = URL) -> Column:
    """All links of a text, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def find_resource_ids(text: Column, patterns: Sequence[str]) -> Column:
    """What the caller's patterns find, pattern after pattern."""
    return F.flatten(F.array(*[F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in patterns]))


def sanitize(text: Column) -> Column:
    """Error text that is safe to log."""
    for pattern, instead in SANITIZERS:
        text = F.regexp_replace(text, pattern, instead)
    return text
