"""Links in text and the allow-list test, as column expressions without URI parsing.

A link is trusted iff it is ``http``/``https`` with an authority that has no user part, no bracket, is not an IPv4
address, and whose host (up to the first colon, any case) is a listed domain or a subdomain of one. One pattern per
allow-list says exactly that, so the test stays inside the row.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnwarden import fixed_values as fixed
from turnwarden.functions.patterns import java_pattern, literal
from turnwarden.functions.text import rewrite_matches

LINK = java_pattern(fixed.URL_PATTERN, ignore_case=True)
STRICT_LINK = java_pattern(r"\b" + fixed.URL_PATTERN, ignore_case=True)
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
NOT_HOST = r"/?#@:\[" + fixed.SPLIT_LOOKALIKES
NOT_AUTHORITY = r"/?#@\[" + fixed.SPLIT_LOOKALIKES


def _is_ip(domain: str) -> bool:
    try:
        ipaddress.ip_address(domain)
    except ValueError:
        return False
    return True


def trusted_pattern(domains: Sequence[str]) -> str:
    """Pattern that matches exactly the links the allow-list trusts."""
    lowered = [d for d in domains if d == d.lower()]
    own = [literal(d) for d in lowered if not _is_ip(d)]
    below = [literal(d) for d in lowered]
    if not below:
        return r"(?!)"
    hosts = [rf"[^{NOT_HOST}]*\.(?:{'|'.join(below)})"]
    if own:
        hosts.append(f"(?:{'|'.join(own)})")
    not_ip = rf"(?!{OCTET}(?:\.{OCTET}){{3}}(?:[:/?#]|$))"
    return rf"(?iu)^https?://{not_ip}(?:{'|'.join(hosts)})(?::[^{NOT_AUTHORITY}]*)?(?:[/?#]|$)"


def links(text: Column, strict: bool = False) -> Column:
    """Every link in ``text``, in order. ``strict`` ignores scheme names inside longer words."""
    return F.regexp_extract_all(text, F.lit(STRICT_LINK if strict else LINK), F.lit(0))


def is_trusted(url: Column, domains: Sequence[str]) -> Column:
    return url.rlike(trusted_pattern(domains))


def untrusted_links(text: Column, domains: Sequence[str], strict: bool = False) -> Column:
    return F.filter(links(text, strict), lambda u: ~is_trusted(u, domains))


def redact_untrusted(text: Column, domains: Sequence[str], strict: bool = False) -> Column:
    return rewrite_matches(text, STRICT_LINK if strict else LINK,
                           lambda u: F.when(is_trusted(u, domains), u).otherwise(F.lit(fixed.LINK_MASK)))


def host(url: Column) -> Column:
    """Lower-cased host of an ``http``/``https`` link, NULL when the link can never be trusted."""
    found = F.regexp_extract(
        url, rf"(?iu)^https?://([^{NOT_HOST}]+)(?::[^{NOT_AUTHORITY}]*)?(?:[/?#]|$)", 1)
    lowered = F.lower(found)
    is_ip = lowered.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    return F.when((found != "") & ~is_ip, lowered)


def host_suffixes(host_name: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``: the domains that would admit this host, for an equi-join."""
    labels = F.split(host_name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
