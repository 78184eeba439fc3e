"""URL checks: validity, blocked domains, blocked extensions, host and base domain."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# A URL is valid if it matches this pattern (ignoring case), has no space and is longer than 8.
MIN_URL_LENGTH = 9
URL_PATTERN = (
    r"^(?:http)s?://"
    r"(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+(?:[A-Z]{2,6}\.?|[A-Z0-9-]{2,}\.?)|"
    r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
    r"(?::\d+)?"
    r"(?:/?|[/?]\S+)$"
)

#: What the pattern asks for after the host.
URL_END = r"(?::\d+)?(?:/?|[/?]\S+)$"

# Domains without usable text.
BLOCKED_DOMAINS = [
    "imgur.com",
    "redd.it",
    "instagram.com",
    "discord.gg",
    "gfycat.com",
    "giphy.com",
    "reddituploads.com",
    "redditmedia.com",
    "twimg.com",
    "sli.mg",
    "magaimg.net",
    "flickr.com",
    "imgflip.com",
    "youtube.com",
    "youtu.be",
    "youtubedoubler.com",
    "vimeo.com",
    "twitch.tv",
    "streamable.com",
    "bandcamp.com",
    "soundcloud.com",
    "reddit.com",
    "gyazo.com",
    "github.com",
    "xkcd.com",
    "twitter.com",
    "spotify.com",
    "itunes.apple.com",
    "facebook.com",
    "gunprime.com",
    "strawpoll.me",
    "voyagefusion.com",
    "rollingstone.com",
    "google.com",
    "timeanddate.com",
    "walmart.com",
    "roanoke.com",
    "spotrac.com",
    "wikipedia.org",
    "battleforthenet.com",
]

# File extensions without usable text.
BLOCKED_EXTENSIONS = [
    ".png",
    ".jpg",
    ".jpeg",
    ".gif",
    ".gifv",
    ".pdf",
    ".mp4",
    ".mp3",
    ".ogv",
    ".webm",
    ".doc",
    ".docx",
    ".log",
    ".csv",
    ".dat",
    ".iso",
    ".bin",
    ".exe",
    ".apk",
    ".jar",
    ".app",
    ".ppt",
    ".pps",
    ".pptx",
    ".xml",
    ".gz",
    ".xz",
    ".bz2",
    ".tgz",
    ".tar",
    ".zip",
    ".wma",
    ".mov",
    ".wmv",
    ".3gp",
    ".svg",
    ".rar",
    ".wav",
    ".avi",
    ".7z",
]

# Common public suffixes of two labels, the default rules; every other suffix is then the last label.
TWO_LABEL_SUFFIXES = [
    f"{second}.{country}"
    for country, seconds in {
        "uk": ["co", "org", "ac", "gov", "me", "ltd", "plc", "net", "sch", "nhs", "police"],
        "au": ["com", "net", "org", "edu", "gov", "id", "asn"],
        "nz": ["co", "net", "org", "govt", "ac", "geek"],
        "jp": ["co", "ne", "or", "ac", "go", "ad", "ed", "gr", "lg"],
        "kr": ["co", "or", "ne", "go", "ac", "re"],
        "in": ["co", "net", "org", "gov", "ac", "edu", "nic", "res"],
        "za": ["co", "org", "gov", "ac", "net", "web"],
        "br": ["com", "net", "org", "gov", "edu"],
        "cn": ["com", "net", "org", "gov", "edu", "ac"],
        "tw": ["com", "net", "org", "gov", "edu"],
        "hk": ["com", "net", "org", "gov", "edu"],
        "sg": ["com", "net", "org", "gov", "edu"],
        "my": ["com", "net", "org", "gov", "edu"],
        "mx": ["com", "net", "org", "gob", "edu"],
        "ar": ["com", "net", "org", "gob", "edu"],
        "tr": ["com", "net", "org", "gov", "edu"],
        "il": ["co", "org", "net", "ac", "gov", "muni"],
        "th": ["co", "or", "ac", "go", "in", "net"],
        "id": ["co", "or", "ac", "go", "web", "net"],
        "ph": ["com", "net", "org", "gov", "edu"],
        "pk": ["com", "net", "org", "gov", "edu"],
        "ua": ["com", "net", "org", "gov", "edu"],
        "pl": ["com", "net", "org", "gov", "edu"],
    }.items()
    for second in seconds
]

HOST_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:@]+)"


def host(url: Column) -> Column:
    """Lower-case host without user, port and trailing dots; null if there is none.

    A pattern, not a URL parser: parsers reject whole URLs over one odd character in the query, and such a URL
    would then slip past the domain blocklist.
    """
    found = F.regexp_replace(F.lower(F.regexp_extract(url, HOST_PATTERN, 1)), r"\.+\z", "")
    return F.when(found != "", found)


@dataclass(frozen=True)
class SuffixRules:
    """Public suffixes as a table of rules: plain ones (``co.uk``), wildcards (``*.ck``: any label below ``ck``) and
    exceptions from these (``!www.ck``: its suffix is ``ck``)."""

    plain: frozenset[str]
    wildcards: frozenset[str] = frozenset()
    exceptions: frozenset[str] = frozenset()

    @classmethod
    def parse(cls, lines: Iterable[str]) -> SuffixRules:
        """From the lines of a public suffix list; comments begin with ``//``, and a line ends at white space."""
        rules = [words[0].lower().strip(".") for words in map(str.split, lines) if words and not words[0].startswith("//")]
        return cls(
            frozenset(r for r in rules if r[:1] not in ("*", "!")),
            frozenset(r[2:] for r in rules if r.startswith("*.")),
            frozenset(r[1:] for r in rules if r.startswith("!")),
        )

    def labels(self) -> int:
        """Most labels that a rule looks at."""
        return max([1, *(r.count(".") + 1 for r in self.plain | self.exceptions), *(r.count(".") + 2 for r in self.wildcards)])


DEFAULT_SUFFIXES = SuffixRules(frozenset(TWO_LABEL_SUFFIXES))


def _suffix_labels(host_col: Column, rules: SuffixRules) -> Column:
    """How many labels of a host are its suffix: those of the longest rule that fits, exceptions before all others; the
    last label if none does."""
    last = [F.substring_index(host_col, ".", -k) for k in range(1, rules.labels() + 1)]
    enough = F.size(F.split(host_col, r"\.", -1))
    found = F.lit(1)
    for k, suffix in enumerate(last, 1):  # the last condition wrapped around is asked first: longer rules, then exceptions
        fits = suffix.isin(*rules.plain) if rules.plain else F.lit(False)
        if k > 1 and rules.wildcards:
            fits = fits | last[k - 2].isin(*rules.wildcards)
        found = F.when((enough >= k) & fits, F.lit(k)).otherwise(found)
    for k, suffix in enumerate(last, 1):
        if k > 1 and rules.exceptions:
            found = F.when((enough >= k) & suffix.isin(*rules.exceptions), F.lit(k - 1)).otherwise(found)
    return found


def _is_ip(host_col: Column) -> Column:
    return host_col.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}\z")


def base_domain(host_col: Column, rules: SuffixRules = DEFAULT_SUFFIXES) -> Column:
    """The registrable domain: suffix plus one label; an IPv4 address, a single label or a bare suffix is returned whole."""
    domain = F.call_function("substring_index", host_col, F.lit("."), -(_suffix_labels(host_col, rules) + 1))
    return F.when(_is_ip(host_col), host_col).otherwise(domain)


def public_suffix(host_col: Column, rules: SuffixRules = DEFAULT_SUFFIXES) -> Column:
    """The suffix below which domains are registered; null for an IPv4 address or a single label."""
    suffix = F.call_function("substring_index", host_col, F.lit("."), -_suffix_labels(host_col, rules))
    return F.when(host_col.contains(".") & ~_is_ip(host_col), suffix)


def is_valid(url: Column) -> Column:
    """Long enough, no space, and the answer of ``URL_PATTERN``; character classes and case folding are Unicode-aware.

    The pattern itself repeats a group, for which the JVM's regex engine recurses, so a host of very many labels would
    overflow a task's stack. Here the host's run of letters, digits, hyphens and dots, which is all that the pattern
    can take as a name, is split at its dots, and each label has a flat pattern of its own.
    """
    flags = "(?iUd)"
    run = F.regexp_extract(url, flags + r"^https?://([A-Z0-9.-]*)", 1)
    scheme = F.regexp_extract(url, flags + r"^https?://", 0)
    rest = F.substr(url, F.length(scheme) + F.length(run) + 1)
    labels = F.split(F.when(run.endswith("."), F.left(run, F.length(run) - 1)).otherwise(run), r"\.", -1)
    name = (F.size(labels) >= 2) & F.forall(
        F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0))),
        lambda label: label.rlike(flags + r"^[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\z"),
    )
    named = (scheme != "") & name & F.element_at(labels, -1).rlike(flags + r"^[A-Z0-9-]{2,}\z") & rest.rlike(flags + "^" + URL_END)
    numbered = url.rlike(flags + r"^https?://\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}" + URL_END)
    return (F.length(url) >= MIN_URL_LENGTH) & ~F.contains(url, F.lit(" ")) & (named | numbered)


def is_blocked_domain(url: Column, domains: list[str] | None = None, rules: SuffixRules = DEFAULT_SUFFIXES) -> Column:
    """Base domain or whole host is on the blocklist."""
    names = BLOCKED_DOMAINS if domains is None else domains
    h = host(url)
    return F.coalesce(h.isin(names) | base_domain(h, rules).isin(names), F.lit(False))


def is_blocked_extension(url: Column, extensions: list[str] | None = None) -> Column:
    """The lower-cased URL up to the first ``?`` ends with a blocked extension; a fragment is not cut off."""
    endings = "|".join(e.lstrip(".") for e in (BLOCKED_EXTENSIONS if extensions is None else extensions))
    return F.substring_index(F.lower(url), "?", 1).rlike(rf"\.(?:{endings})\z")


def exclude_reason(url: Column) -> Column:
    """Why a URL is skipped before its page is touched, or null; the first matching reason wins."""
    return (
        F.when(~F.coalesce(is_valid(url), F.lit(False)), F.lit("invalid_url"))
        .when(is_blocked_domain(url), F.lit("blocked_domain"))
        .when(is_blocked_extension(url), F.lit("blocked_extension"))
    )
