"""Canonical hostnames, platforms and statuses."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetmatch.functions.text import capitalise, present, trim

# Domain suffixes, removed in this order, and the NetBIOS limit.
DOMAIN_SUFFIXES = (".CORPORATE.GHA.COM", ".GHA.COM", ".CORP", ".LOCAL")
HOSTNAME_LENGTH = 15

# Words that identify a platform family or a status.
MACOS_WORDS = ("macos", "mac os", "darwin")
LINUX_WORDS = ("linux", "ubuntu", "centos", "rhel", "debian", "suse")
ONLINE_WORDS = ("1", "true", "yes", "online", "active")
OFFLINE_WORDS = ("0", "false", "no", "offline", "inactive")


def full_hostname(hostname: Column, suffixes: Sequence[str] = DOMAIN_SUFFIXES) -> Column:
    """Upper-case hostname without domain, before it is cut to NetBIOS length.

    Each suffix is removed at most once, in the order given, so ``X.LOCAL.CORP``
    becomes ``X`` and ``X.CORP.LOCAL`` becomes ``X.CORP``.
    """
    name = F.upper(trim(present(hostname)))
    short = name
    for suffix in suffixes:
        short = F.regexp_replace(short, re.escape(suffix) + r"\z", "")
    if not all(suffix.startswith(".") for suffix in suffixes):
        return short
    # Most hostnames carry no domain and need no regular expression.
    return F.when(F.contains(hostname, F.lit(".")), short).otherwise(name)


def normalize_hostname(hostname: Column, suffixes: Sequence[str] = DOMAIN_SUFFIXES,
                       length: int = HOSTNAME_LENGTH) -> Column:
    """The matching key. Apply exactly once: a second pass can strip another suffix."""
    return F.substring(full_hostname(hostname, suffixes), 1, length)


def _contains_any(text: Column, words: Sequence[str]) -> Column:
    found = F.contains(text, F.lit(words[0]))
    for word in words[1:]:
        found = found | F.contains(text, F.lit(word))
    return found


def normalize_platform(platform: Column) -> Column:
    name = F.lower(trim(platform))
    return (
        F.when(present(platform).isNull(), "UNKNOWN")
        .when(F.contains(name, F.lit("windows")) & F.contains(name, F.lit("server")), "Windows Server")
        .when(F.contains(name, F.lit("windows")), "Windows")
        .when(_contains_any(name, MACOS_WORDS), "macOS")
        .when(_contains_any(name, LINUX_WORDS), "Linux")
        .otherwise(capitalise(name))
    )


def normalize_status(status: Column) -> Column:
    word = F.lower(trim(status))
    return (
        F.when(present(status).isNull(), "Unknown")
        .when(word.isin(*ONLINE_WORDS), "Online")
        .when(word.isin(*OFFLINE_WORDS), "Offline")
        .otherwise(capitalise(word))
    )
