"""Column expressions over links."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .lexicon import RECOVER_WORDS, REPORT_WORDS
from .text import let, strip

#: Redirects inside redirects that are unwrapped.
LEVELS = 8


def is_redirect(url: Column) -> Column:
    return url.rlike(r"(?i)^[a-z]+://(?:[^/?#]*\.)?google\.[a-z.]+/url\?")


def unwrapped(url: Column) -> Column:
    """The target of a search engine's redirect link, else the link."""

    def target(u: Column) -> Column:
        found = F.coalesce(F.try_parse_url(u, F.lit("QUERY"), F.lit("url")), F.try_parse_url(u, F.lit("QUERY"), F.lit("q")))
        return F.when(is_redirect(u), F.coalesce(F.try_url_decode(found), u)).otherwise(u)

    return let(url, target)


def _based(url: Column) -> Column:
    mended = F.regexp_replace(F.replace(strip(url), F.lit(" "), F.lit("%20")), r"(?i)^h+(ttps?://)", "h$1")
    return let(mended, lambda c: F.when(c.startswith("//"), F.concat(F.lit("https:"), c)).when((c != "") & ~c.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), F.concat(F.lit("https://"), c)).otherwise(c))


def clean_url(url: Column) -> Column:
    """Trimmed, blanks encoded, doubled letters and missing schemes mended, redirects unwrapped up to LEVELS deep."""
    step = lambda u, _: F.when(is_redirect(u), let(unwrapped(u), lambda t: F.when(t == u, u).otherwise(_based(t)))).otherwise(u)
    # Most links are no redirects, and only those that are go through the levels.
    return let(_based(url), lambda c: F.when(is_redirect(c), F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), c, step)).otherwise(c))


def mirror_key(url: Column) -> Column:
    c = F.regexp_replace(strip(url), r"(?i)^https?://", "")
    return F.lower(F.regexp_replace(F.substring_index(c, "?", 1), "/+$", ""))


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def origin(url: Column) -> Column:
    return F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY")))


def has_host(url: Column) -> Column:
    return F.coalesce(host(url).contains("."), F.lit(False))


def absolute(link: Column, base: Column) -> Column:
    """A link seen from its page: absolute, scheme-relative, rooted or relative to the page's folder."""
    root, folder = origin(base), F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(://[^/]+)$|/[^/]*$", "$1")
    return F.when(link.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(F.try_parse_url(base, F.lit("PROTOCOL")), F.lit(":"), link)).when(link.startswith("/"), F.concat(root, link)).otherwise(F.concat(folder, F.lit("/"), link))


def report_links(html: Column, base: Column, most: int | None = None) -> Column:
    """Links to reports on a page, those with report words first, each once, repaired."""
    refresh = F.regexp_extract_all(html, F.lit(r"""(?i)http-equiv=[\x22\x27]refresh[\x22\x27][^>]*content=[\x22\x27][^\x22\x27]*url=([^\x22\x27>]+)"""), 1)
    files = F.regexp_extract_all(html, F.lit(r"""(?i)(?:href|src|data)=[\x22\x27]([^\x22\x27]*\.pdf(?:\?[^\x22\x27]*)?)[\x22\x27]"""), 1)
    loads = F.regexp_extract_all(html, F.lit(r"""(?i)href=[\x22\x27]([^\x22\x27]*/(?:download|getfile|dokument)[^\x22\x27]*)[\x22\x27]"""), 1)
    found = F.concat(F.transform(F.slice(refresh, 1, 1), strip), files, loads)
    fit = F.filter(found, lambda x: ~x.rlike("(?i)^(?:javascript:|mailto:|#|data:)"))
    worded = F.array_sort(F.transform(fit, lambda x, i: F.struct(F.when(F.lower(x).rlike("|".join(REPORT_WORDS)), 0).otherwise(1).alias("rank"), i.alias("pos"), x.alias("link"))))
    out = F.array_distinct(F.transform(worded, lambda x: clean_url(absolute(x["link"], base))))
    return out if most is None else F.slice(out, 1, most)


def recover_links(html: Column, base: Column) -> Column:
    """Links of a second try: redirect and .pdf links, absolute, those with report words first, each once, as they are."""
    refresh = F.regexp_extract_all(html, F.lit(r"""(?i)http-equiv=[\x22\x27]refresh[\x22\x27][^>]*content=[\x22\x27][^\x22\x27]*url=([^\x22\x27>]+)"""), 1)
    files = F.regexp_extract_all(html, F.lit(r"""(?i)(?:href|src)=[\x22\x27]([^\x22\x27]*\.pdf(?:\?[^\x22\x27]*)?)[\x22\x27]"""), 1)
    found = F.transform(F.concat(F.transform(F.slice(refresh, 1, 1), strip), files), lambda x: absolute(x, base))
    worded = F.array_sort(F.transform(found, lambda x, i: F.struct(F.when(F.lower(x).rlike("|".join(RECOVER_WORDS)), 0).otherwise(1).alias("rank"), i.alias("pos"), x.alias("link"))))
    return F.array_distinct(F.transform(worded, lambda x: x["link"]))


def headers(url: Column, agent: str) -> Column:
    """What a browser sends along, with the link's origin as referer."""
    known = {"User-Agent": agent, "Accept": "application/pdf,text/html,application/xhtml+xml,*/*;q=0.8", "Accept-Language": "en-US,en;q=0.9"}
    return F.create_map(*[F.lit(x) for pair in known.items() for x in pair], F.lit("Referer"), F.concat(origin(url), F.lit("/")))
