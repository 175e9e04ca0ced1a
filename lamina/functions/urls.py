"""URL normalization (P3) as a native Column expression.

``protocol://host + path``: drops port, user-info, query and fragment, lower-cases the
scheme, keeps the host's case, does not decode or complete the path. The rules are those of the
JDK's URL class for a URL without a context; what it refuses is returned unchanged. Dot segments
stay: that class takes them out only where it resolves a path against another one
(``tests/test_urls.py`` compares with the class of the JVM).

* Characters up to the blank are cut at both ends, and so is a leading ``url:``.
* ``http``, ``https``, ``ftp`` and ``file`` URLs have a fragment (from ``#``), a query (from
  ``?``), an authority (after ``//``, but not after ``////``) and a path. An authority has a
  user-info (up to ``@``; with several ``@`` the host is empty), a host or an IPv6 address in
  brackets, and a port (a number of 32 bits, -1 at least).
* ``mailto`` URLs need an address, which is their path up to the last ``?``. ``jar`` URLs are an
  inner URL that parses, ``!/`` and an entry; all of it is the path. Neither has a host.
* A text without a scheme, or with another one, is no URL here.

Almost all URLs are plain ones: one anchored pattern splits and rewrites these in a single
pass. Only the others go through the rules one by one (a row takes one branch of a ``CASE``).
Inner URLs of ``jar`` that are ``jar`` URLs themselves are taken not to parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as blank at the ends, and the schemes with an authority.
BLANKS = "".join(map(chr, range(33)))
HIERARCHICAL = ("http", "https", "ftp", "file")
# Separator between the parts of the rewritten text; a scheme can't hold it.
_SEP = "\x01"
# scheme, host and path of a plain URL: at most one @, no brackets, a port of up to nine digits
_PLAIN = (
    r"(?s)^([hH][tT][tT][pP][sS]?|[fF][tT][pP]|[fF][iI][lL][eE])://(?!//)(?:[^/?#@]*@)?"
    r"((?:[^\[:/?#@\x01][^:/?#@\x01]*)?)(?::[0-9]{0,9})?(?=[/?#]|$)([^?#]*)(?:[?#].*)?$"
)
_GROUP = "[0-9A-Fa-f]{1,4}"
_IPV4 = r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)"


def _ipv6() -> str:
    """An IPv6 address, with a scope if there is one: eight groups, or fewer around ``::``, the
    last two of which may be an IPv4 address."""
    forms = [f"(?:{_GROUP}:){{7}}{_GROUP}", f"(?:{_GROUP}:){{6}}{_IPV4}"]
    for left in range(8):
        before = f"(?:{_GROUP}:){{{left - 1}}}{_GROUP}" if left else ""
        ends = [f"(?:{_GROUP}:){{0,{6 - left}}}{_GROUP}"] if left < 7 else []
        ends += [f"(?:{_GROUP}:){{0,{5 - left}}}{_IPV4}"] if left < 6 else []
        forms.append(f"{before}::" + (f"(?:{'|'.join(ends)})?" if ends else ""))
    return f"(?:{'|'.join(forms)})(?:%.+)?"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once: an expression that names it many times
    would otherwise hold it many times."""
    return F.get(F.transform(F.array(value), body), 0)


def _after(text: Column, head: Column, more: int = 0) -> Column:
    """What follows ``head`` and ``more`` characters."""
    return text.substr(F.length(head) + 1 + more, F.length(text))


def _host(place: Column) -> Column:
    bracket = F.concat(F.substring_index(place, "]", 1), F.lit("]"))
    return F.when(place.startswith("["), bracket).otherwise(F.substring_index(place, ":", 1))


def _tail_parses(tail: Column) -> Column:
    """Whether what follows a host is nothing, or a port."""
    signed = tail.rlike(r"^:-0*[01]$")
    number = tail.rlike(r"^:\+?[0-9]+$") & (tail.substr(F.lit(2), F.length(tail)).try_cast("bigint") <= 2147483647)
    return (tail == "") | (tail == ":") | signed | F.coalesce(number, F.lit(False))


def _hierarchical(scheme: Column, rest: Column) -> Column:
    """The normalized form of a URL with authority, or null. ``rest``: after the scheme."""
    text = F.substring_index(F.substring_index(rest, "#", 1), "?", 1)

    def split(t: Column) -> Column:
        has = t.startswith("//") & ~t.startswith("////")
        authority = F.when(has, F.substring_index(t.substr(F.lit(3), F.length(t)), "/", 1))
        return _let(authority, lambda a: F.when(a.isNull(), joined(F.lit(""), t)).otherwise(_let(_place(a), lambda p: joined(p, _after(t, a, 2)))))

    def joined(place: Column, path: Column) -> Column:
        literal = ~place.startswith("[") | place.rlike(rf"^\[{_ipv6()}\]")
        good = lambda host: F.when(literal & _let(_after(place, host), _tail_parses), F.concat(scheme, F.lit("://"), host, path))
        return _let(_host(place), good)

    return _let(text, split)


def _place(authority: Column) -> Column:
    """An authority's host and port: after an ``@``, nothing after several."""
    ats = F.length(authority) - F.length(F.replace(authority, F.lit("@")))
    return F.when(ats == 0, authority).when(ats == 1, F.substring_index(authority, "@", -1)).otherwise(F.lit(""))


def _upto_last_query(rest: Column) -> Column:
    return F.regexp_replace(rest, r"\?[^?]*$", "")


def _parsed(text: Column, body) -> Column:
    """``body`` of the scheme, in lower case, and of what follows it up to the fragment."""
    bare = F.regexp_replace(text, r"^[uU][rR][lL]:", "")
    scheme = lambda t: F.lower(F.regexp_extract(t, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return _let(bare, lambda t: _let(scheme(t), lambda s: _let(F.substring_index(_after(t, s, 1), "#", 1), lambda rest: body(s, rest))))


def _has_address(rest: Column) -> Column:
    return rest.rlike(r"[^\s\x1c-\x1f]")


def _by_rules(raw: Column, text: Column) -> Column:
    """The normalized form of any URL, or null if it doesn't parse."""

    def inner_parses(scheme: Column, rest: Column) -> Column:
        return F.when(scheme.isin(*HIERARCHICAL), _hierarchical(scheme, rest).isNotNull()).otherwise((scheme == "mailto") & _has_address(rest))

    def form(scheme: Column, rest: Column) -> Column:
        mail = F.when(_has_address(rest), F.concat(F.lit("mailto://"), _upto_last_query(rest)))
        entry = F.btrim(F.regexp_extract(rest, r"(?s)^(.*)!/", 1), F.lit(BLANKS))
        jar = F.lower(raw).startswith("jar:") & rest.contains("!/") & _parsed(entry, inner_parses)
        jar = F.when(jar, F.concat(F.lit("jar://"), _upto_last_query(rest)))
        return F.when(scheme.isin(*HIERARCHICAL), _hierarchical(scheme, rest)).when(scheme == "mailto", mail).when(scheme == "jar", jar)

    return _parsed(text, form)


def normalize_url(url) -> Column:
    """Normalized form of ``url`` (a column or column name).

    One anchored ``regexp_replace`` rewrites a plain URL to scheme, host and path between
    separators; "the text changed" means that it was one."""
    raw = F.col(url) if isinstance(url, str) else url
    text = F.btrim(raw, F.lit(BLANKS))
    rewritten = F.regexp_replace(text, _PLAIN, f"$1{_SEP}$2{_SEP}$3")
    parts = F.split(rewritten, _SEP, 3)
    plain = F.concat(F.lower(parts.getItem(0)), F.lit("://"), parts.getItem(1), parts.getItem(2))
    return F.when(rewritten != text, plain).when(text.contains(":"), F.coalesce(_by_rules(raw, text), raw)).otherwise(raw)
